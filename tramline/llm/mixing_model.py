"""LM scoring by online logistic context mixing.

Three bit predictors (two preceding bytes, four preceding bytes, and the current word's beginning, each hashed to a
slot with the last byte of another script than ASCII) hold counts from all training texts. A byte is coded as the bits of its path in a Huffman tree. In the logistic
domain the predictors' estimates are summed under weights; each weight is gated by its predictor's confidence and is
refined by gradient steps while a text goes by, starting anew for each text, so a score doesn't depend on other rows
beside the counts.

A word with the break after it is coded by a mixture of two: the bit predictors, and the word's count in all training
texts. The counts of words are a table that grows with the corpus. A text's probability is the mean over several shares
of the two, so the share that fits the text's words so far prevails.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterable, Iterator
from itertools import accumulate, count, pairwise
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tramline.llm.common import IS_SPACE, LOWER, Scratch, cut, doc_texts, flat, id_crc32, lists, table, word_bounds
from tramline.llm.repeats import BASES, BYTE_VALUES, Rolling

#: Symbols: the bytes and the end of a text.
END, SYMBOLS = 256, 257
#: Slots of each predictor's hashed contexts. The model has at most sum(SLOTS) * SYMBOLS counts, at any corpus size.
SLOTS = (1 << 13, 1 << 15, 1 << 15)
#: Slots whose entries one group makes.
PART_SLOTS = 1 << 10
WORD_REACH = 6
#: Counts from which a context is of confidence 1, 2 and 3.
CONFIDENT = (1, 4, 32)
#: Weights that each text starts with: predictor by confidence.
START = np.array([[0, 0.2, 0.2, 0.2], [0, 0.35, 0.4, 0.4], [0, 0.3, 0.45, 0.5]], np.float32)
#: Bytes of text whose symbols' contexts and words are found at a time.
STEP_BYTES = 1 << 19
#: Bytes of text scored side by side, so that long texts leave few steps with little in them; texts of one step, whose
#: arrays fit a core's cache.
SIDE_BYTES, SIDE_TEXTS = 1 << 21, 128
RATE, BLOCK, LEAST_P = 2.0, 256, 1e-4
#: Common words whose counts every task holds (16 bytes each); the other words' counts are joined.
HEAD_WORDS = 1 << 16
#: Bins of an octave of counts, from which the common words are told.
FINE = 64
#: Distinct words that a task holds before it passes their counts on.
HELD_WORDS = 1 << 20
WORDS = -1
#: Shares of a word's count beside the bit predictors, each as likely before a text begins.
SHARES = (0.01, 0.1, 0.3, 0.5, 0.7, 0.9)
#: Log2 of an odds from which a sum is its greater part.
SURE = 50


SPACE_SYMBOLS = np.append(IS_SPACE, False)
IS_BREAK = np.append(IS_SPACE, True)


def symbols(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lower-case bytes with the end after each text, and their offsets."""
    return np.insert(LOWER[data].astype(np.uint16), offsets[1:], END), offsets + np.arange(len(offsets))


def contexts(syms: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
    """Each predictor's slot at each symbol; no context reaches into another text."""
    begins, n = offsets[:-1], len(syms)
    byte = np.zeros(n + 8, np.uint8)
    byte[8:] = syms & 0xFF
    # the WORD_REACH bytes before each symbol, the nearest lowest
    reach = np.array([(1 << 8 * k) - 1 for k in range(WORD_REACH + 1)], np.uint64)
    last = np.ndarray(n, ">u8", byte, strides=(1,)).astype(np.uint64)
    for k in range(WORD_REACH):
        inside = begins[begins + k < offsets[1:]] + k
        last[inside] &= reach[k]

    new = np.zeros(n, bool)
    new[1:] = SPACE_SYMBOLS[syms[:-1]]
    new[begins] = True
    # symbols of the word before each, up to WORD_REACH: one for each k of which the last k + 1 symbols begin no word
    in_word, near = (~new).view(np.uint8), new.copy()
    for k in range(1, WORD_REACH):
        near[k:] |= new[:-k]
        in_word += ~near
    high = np.zeros(n, bool)
    high[1:] = (syms[:-1] >= 0x80) & (syms[:-1] < END)
    new = high.copy()
    new[begins] = True
    places = np.flatnonzero(new)
    told = high[places]
    told[0] = False
    hint = np.repeat(np.where(told, BYTE_VALUES[byte[places + 7]], np.uint64(0)), np.diff(np.append(places, n)))
    out = []
    for seen, b, slots in zip((reach[2], reach[4], reach.take(in_word)), BASES, SLOTS, strict=False):
        x = last & seen
        x ^= hint
        x *= np.uint64(b)
        x >>= np.uint64(65 - slots.bit_length())
        out.append(x.view(np.int64))
    return out


def gathered(train: DataFrame) -> DataFrame:
    """(which, key, n): counts of words (hashed) and of each predictor's (slot, symbol), added up within each task."""

    def find(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = [np.zeros(n * SYMBOLS, np.int32) for n in SLOTS]
        words, counts = [], []

        def told(which: int, key: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(np.full(len(key), which, np.int32)), pa.array(key.astype(np.int64)), pa.array(n.astype(np.int64))], names=["which", "key", "n"])

        def merged() -> tuple[np.ndarray, np.ndarray]:
            key, back = np.unique(np.concatenate(words), return_inverse=True)
            return key, np.bincount(back, np.concatenate(counts)).astype(np.int64)

        for batch in cut(batches, most=STEP_BYTES):
            data, offsets = flat(batch.column("text"))
            syms, at = symbols(data, offsets)
            for cells, slots in zip(tables, contexts(syms, at), strict=True):
                np.add.at(cells, slots * SYMBOLS + syms, np.int32(1))  # of one kind: numpy's fast way
            starts, ends, _ = word_bounds(data, offsets)
            key, n = np.unique(Rolling(BYTE_VALUES[LOWER[data]], BASES[1])(starts, ends).view(np.int64), return_counts=True)
            words.append(key)
            counts.append(n)
            if sum(map(len, words)) > 4 * HELD_WORDS:
                key, n = merged()
                words, counts = [key], [n]
                if len(key) > HELD_WORDS:
                    yield told(WORDS, key, n)
                    words, counts = [], []
        if words:
            yield told(WORDS, *merged())
        for which, cells in enumerate(tables):
            key = np.flatnonzero(cells)
            yield told(which, key, cells[key])

    rows = train.select("text").mapInArrow(find, "which int, key long, n long")
    rows = rows.repartition("which", "key")  # a task's keys are distinct nearly: nothing is gained by adding up before the shuffle
    return rows.groupBy("which", "key").agg(F.sum("n").alias("n"))


class Model(NamedTuple):
    """What every task holds: the code's paths, the predictors, and the common words' counts."""

    length: np.ndarray
    first: np.ndarray
    nodes: np.ndarray
    bits: np.ndarray
    tables: list[np.ndarray]
    head: np.ndarray
    head_counts: np.ndarray
    total: int
    distinct: int
    #: Log2 of a symbol's share among the breaks that can follow a word; other symbols have none.
    breaks: np.ndarray


#: The logit that a table's entry stands for.
LOGITS = ((np.arange(256) >> 2) - 32).astype(np.float32) / 4
#: The same by confidence: a column for each.
WORTH = np.where((np.arange(256) & 3)[:, None] == np.arange(4), LOGITS[:, None], np.float32(0))
IN_COLUMN = ((np.arange(256) & 3)[:, None] == np.arange(4)).astype(float)
#: Beyond it a bit's probability is held, at LEAST_P from 0 and 1.
MOST_LOGIT = np.float32(np.log(1 / LEAST_P - 1))
#: Counts an error in sums of errors, which are far smaller: one sum then holds both. Sums of errors times logits, which
#: are multiples of a quarter, are under ONE / 8 too: a block has at most BLOCK * 256 bits, and logits are 8 at most.
ONE = float(1 << 22)
#: Sums for each kind to sums by confidence: of errors times logits, and of errors.
TO_SUMS = np.hstack((WORTH, IN_COLUMN))


def huffman(weights: np.ndarray) -> list[list[tuple[int, int]]]:
    """For each symbol, its path: (inner node, bit). Node numbers are under len(weights) - 1."""
    ids, heap = count(), []
    for symbol, w in enumerate(weights):
        heapq.heappush(heap, (int(w), next(ids), [symbol]))
    paths: list[list[tuple[int, int]]] = [[] for _ in weights]
    node = 0
    while len(heap) > 1:
        (a, _, left), (b, _, right) = heapq.heappop(heap), heapq.heappop(heap)
        for bit, part in enumerate((left, right)):
            for symbol in part:
                paths[symbol].append((node, bit))
        node += 1
        heapq.heappush(heap, (a + b, next(ids), left + right))
    return [p[::-1] for p in paths]


def packed(counts: np.ndarray, paths: list[list[tuple[int, int]]]) -> np.ndarray:
    """A predictor's table: for each slot and inner node, the estimate's logit (in quarters, from -8) times 4, plus its confidence.

    A node at a time, so that little is held beside the table.
    """
    below: list[tuple[list[int], list[int]]] = [([], []) for _ in range(SYMBOLS - 1)]
    for symbol, path in enumerate(paths):
        for node, bit in path:
            below[node][bit].append(symbol)
    out = np.empty((counts.shape[0], SYMBOLS - 1), np.uint8)
    used = counts.any(axis=0)
    for node, (zeros, ones) in enumerate(below):
        n0, n1 = (counts[:, [x for x in part if used[x]]].sum(axis=1, dtype=np.float32) for part in (zeros, ones))
        logit = np.clip(np.rint(np.log((n1 + 0.4) / (n0 + 0.4)) * 4), -32, 31) + 32
        out[:, node] = logit * 4 + np.digitize(n0 + n1, CONFIDENT)
    return out.ravel()


def common_words(words: DataFrame) -> pd.DataFrame:
    """(key, n) by key of at most HEAD_WORDS words, the commonest: those whose count's logarithm is over a level.

    The level is read from a histogram of logarithms, of FINE bins an octave. Words of a level that doesn't fit whole
    are left to the join; which words are here changes no score.
    """
    level = F.floor(F.log2("n") * FINE).alias("level")
    bins = sorted(words.groupBy(level).count().collect(), reverse=True)
    fit = [b["level"] for b, n in zip(bins, accumulate(b["count"] for b in bins), strict=True) if n <= HEAD_WORDS]
    found = words.filter(level >= fit[-1]) if fit else words.filter("false")
    return found.select("key", "n").toPandas().sort_values("key")


def fitted(stats: DataFrame, n_train: int) -> Model:
    """Brings the model's bounded parts to the driver: HEAD_WORDS words, and a byte for each of sum(SLOTS) * 256 inner nodes.

    A group for each PART_SLOTS slots of a predictor builds that part of its table, from at most PART_SLOTS * SYMBOLS counts.
    """
    words = stats.filter(F.col("which") == WORDS)
    total, distinct = words.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    top = common_words(words)
    cells = stats.filter(F.col("which") >= 0)
    weights = np.ones(SYMBOLS)
    for symbol, n in cells.filter("which = 0").groupBy((F.col("key") % SYMBOLS).alias("symbol")).agg(F.sum("n")).collect():
        weights[symbol] += n
    paths = huffman(weights)

    def build(key: tuple, rows: pa.Table) -> pa.Table:
        which, part = (x.as_py() for x in key)
        held = np.zeros(PART_SLOTS * SYMBOLS, np.float32)
        held[rows.column("key").to_numpy() - part * len(held)] = rows.column("n").to_numpy()
        return pa.table({"which": pa.array([which], pa.int32()), "part": pa.array([part], pa.int64()), "entries": pa.array([packed(held.reshape(-1, SYMBOLS), paths).tobytes()], pa.binary())})

    tables = [np.full(n * (SYMBOLS - 1), 128, np.uint8) for n in SLOTS]
    parts = cells.groupBy("which", F.expr(f"key div {PART_SLOTS * SYMBOLS}").alias("part"))
    for which, part, entries in parts.applyInArrow(build, "which int, part long, entries binary").collect():
        tables[which][part * PART_SLOTS * (SYMBOLS - 1) :][: len(entries)] = np.frombuffer(entries, np.uint8)
    length = np.array([len(p) for p in paths])
    return Model(
        length, np.cumsum(length) - length, np.array([x for p in paths for x, _ in p]), np.array([b for p in paths for _, b in p], bool),
        tables, top["key"].to_numpy(np.int64), top["n"].to_numpy(np.int64), total + n_train, distinct + (n_train > 0),
        np.log2(weights / weights[IS_BREAK].sum()),
    )


def log2_scores(syms: np.ndarray, offsets: np.ndarray, model: Model) -> np.ndarray:
    """Log2 of each text's probability under the bit predictors."""
    return np.add.reduceat(symbol_scores(syms, offsets, model), offsets[:-1])


def symbol_scores(syms: np.ndarray, offsets: np.ndarray, model: Model) -> np.ndarray:
    """Log2 of each symbol's probability. Texts go by side by side, a block of each of SIDE_TEXTS at a time.

    Within a block a text's weights stand still, so a table's entry (256 kinds) adds the same for every bit of the text,
    and the gradient needs only the sum of errors for each kind.
    """
    n = len(offsets) - 1
    symbols_of = np.diff(offsets)
    number = -(-symbols_of // BLOCK)
    owner = np.repeat(np.arange(n), number)
    turn = np.arange(len(owner)) - np.repeat(np.cumsum(number) - number, number)
    # of each turn, texts with more blocks to come are first: the others' weights aren't needed again
    order = np.lexsort((-number[owner], turn))
    parts = np.unique(np.append(np.searchsorted(offsets, np.arange(0, len(syms), STEP_BYTES)), n))
    parts = [contexts(syms[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]) for a, b in pairwise(parts.tolist())]
    slots = [np.concatenate([x.astype(np.int32) for x in part]) for part in zip(*parts, strict=True)]
    signs = np.where(model.bits, np.float32(1), np.float32(-1))
    weights = np.repeat(START[:, None, :], n, axis=1)
    score = np.zeros(len(syms))
    turns = np.append(np.flatnonzero(np.diff(turn[order], prepend=-1)), len(order)).tolist()
    steps = [(k, at, min(at + SIDE_TEXTS, end)) for k, (begin, end) in enumerate(pairwise(turns)) for at in range(begin, end, SIDE_TEXTS)]
    for k, begin, end in steps:
        texts = owner[order[begin:end]]
        held = np.minimum(symbols_of[texts] - k * BLOCK, BLOCK)
        first = np.cumsum(held) - held
        at = np.arange(held.sum()) + np.repeat(offsets[texts] + k * BLOCK - first, held)
        s = syms[at]
        size = model.length[s]
        begin = np.cumsum(size) - size
        path = np.repeat(model.first[s] - begin, size)
        path += np.arange(len(path))
        node, sign = model.nodes.take(path), signs.take(path)
        bits = np.add.reduceat(size, first)
        entry = np.repeat(np.arange(len(texts)) << 8, bits)
        x, kinds = np.zeros(len(path), np.float32), []
        for w, cells, slot in zip(weights, model.tables, slots, strict=True):
            kind = np.repeat(slot.take(at).astype(np.int64) << 8, size)
            kind += node
            kind = entry + cells.take(kind)
            x += (w[texts] @ WORTH.T).ravel().take(kind)
            kinds.append(kind)
        # to the probability of the bit that came
        x *= sign
        np.clip(x, -MOST_LOGIT, MOST_LOGIT, out=x)
        np.negative(x, out=x)
        np.exp(x, out=x)
        x += 1
        np.reciprocal(x, out=x)
        score[at] = np.add.reduceat(np.log(x), begin)
        more = int(np.count_nonzero(number[texts] > k + 1))
        if not more:
            continue
        until = int(bits[:more].sum())
        error = np.subtract(1, x[:until], dtype=np.float64)
        error *= sign[:until]
        error += ONE
        for w, kind in zip(weights, kinds, strict=True):
            slope, errors = np.hsplit(np.bincount(kind[:until], error, more << 8).reshape(-1, 256) @ TO_SUMS, 2)
            slope = slope - np.rint(slope / (ONE / 4)) * (ONE / 4)
            w[texts[:more]] += RATE * slope / (np.rint(errors / ONE) + 64)
    return score / np.log(2)


def sides(batches: Iterable[pa.RecordBatch], model: Model) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """The batches in slices of STEP_BYTES with symbol_scores, which were made for SIDE_BYTES together."""
    for wide in cut(batches, most=SIDE_BYTES):
        scores, done = symbol_scores(*symbols(*flat(wide.column("text"))), model), 0
        for batch in cut([wide], most=STEP_BYTES):
            offsets = flat(batch.column("text"))[1]
            size = int(offsets[-1]) + batch.num_rows
            yield batch, scores[done : done + size]
            done += size


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """A row for each of docs, with a row number, and its scores without the counts of the words in `rare`.

    score is log2 of what the bit predictors give, gains what the common words' counts add to it for each share, and
    spelt what the bit predictors give each word in `rare`.
    """
    held = docs.sparkSession.sparkContext.broadcast(model)

    def find(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m, row = held.value, TaskContext.get().partitionId() << 40
        scale = m.total + (m.distinct + 1)
        for batch, scores in sides(batches, m):
            data, offsets = flat(batch.column("text"))
            n = batch.num_rows
            syms, at = symbols(data, offsets)
            until = np.append(0, np.cumsum(scores))
            score = np.diff(until[at])
            starts, ends, at = word_bounds(data, offsets)
            key = Rolling(BYTE_VALUES[LOWER[data]], BASES[1])(starts, ends).view(np.int64)
            n_words = np.diff(at)
            owner = np.repeat(np.arange(n), n_words)
            # what the bit predictors give a word and its break, less the share of that break
            spelt = until[ends + owner + 1] - until[starts + owner] - m.breaks[syms[ends + owner]]
            place = np.minimum(np.searchsorted(m.head, key), max(0, len(m.head) - 1))
            common = m.head[place] == key if len(m.head) else np.zeros(len(key), bool)
            logs = np.log10((m.head_counts + 1) / scale)
            base = np.bincount(owner[common], logs[place[common]], n) if common.any() else np.zeros(n)
            rare = np.bincount(owner[~common], minlength=n)
            gains = np.zeros((n, len(SHARES)))
            if common.any():
                odds, of = np.log2(m.head_counts / scale)[place[common]] - spelt[common], owner[common]
                ratio, sure = np.exp2(np.minimum(odds, SURE)), np.flatnonzero(odds > SURE)
                for k, share in enumerate(SHARES):
                    gain = np.log2(1 - share + share * ratio)
                    gain[sure] = odds[sure] + np.log2(share)
                    gains[:, k] = np.bincount(of, gain, n)
            at = pa.array(np.concatenate(([0], np.cumsum(rare))).astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(row + np.arange(n)), batch.column("doc_id"), batch.column("held_out"), pa.array(n_words + 1), pa.array(n_words - rare),
                    pa.array(base), pa.array(score), pa.array(np.diff(offsets)),
                    pa.ListArray.from_arrays(at, pa.array(key[~common])), pa.ListArray.from_arrays(at, pa.array(spelt[~common])), lists(gains.ravel(), np.full(n, len(SHARES)), pa.float64()),
                ],
                names=["row", "doc_id", "held_out", "n_tokens", "n_common", "base", "score", "n_bytes", "rare", "spelt", "gains"],
            )
            row += n

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "held_out", "text").mapInArrow(find, f"row long, doc_id {kind}, held_out boolean, n_tokens long, n_common long, base double, score double, n_bytes long, rare array<long>, spelt array<double>, gains array<double>")


def language_scores(docs: DataFrame, held_out: str = "crc % 7 = 2") -> DataFrame:
    """Scores of each row's text under the unigram base and the mixing model, both learnt from the rows not held out.

    held_out is SQL over `crc`, the CRC-32 of the id as text (a null id: of empty text). Null text counts as empty; an
    empty text is one end token. Without training rows all counts are zero and V is 0. Repeated rows each count. Words
    are known by 64-bit hashes.
    """
    scratch = Scratch(docs.sparkSession, "lm")
    rows = doc_texts(docs).withColumn("crc", id_crc32(F.col("doc_id"))).withColumn("held_out", F.expr(held_out))
    train = rows.filter("NOT held_out")
    stats = scratch.keep(gathered(train), "stats")
    n_train = train.count()
    model = fitted(stats, n_train)
    out = scratch.keep(scored(rows, model), "scored")
    scale = F.lit(float(model.total + model.distinct + 1))
    rare = out.select("row", F.explode(F.arrays_zip("rare", "spelt")).alias("x")).select("row", F.col("x.rare").alias("key"), "x.spelt")
    rare = rare.join(stats.filter(F.col("which") == WORDS).select("key", "n"), "key", "left")
    odds = F.coalesce(F.log2(F.col("n") / scale) - F.col("spelt"), F.lit(float("-inf")))
    gains = [F.when(odds > SURE, odds + float(np.log2(x))).otherwise(F.log2(1 - x + x * F.pow(F.lit(2.0), odds))) for x in SHARES]
    rare = rare.groupBy("row").agg(F.sum(F.log10((F.coalesce("n", F.lit(0)) + 1) / scale)).alias("more"), F.count("n").alias("known"), F.array(*map(F.sum, gains)).alias("more_gains"))
    end = F.log10((F.lit(n_train) + 1) / scale)
    out = out.join(rare, "row", "left").withColumn("gains", F.when(F.col("more_gains").isNull(), F.col("gains")).otherwise(F.zip_with("gains", "more_gains", lambda x, y: x + y)))
    mean = F.aggregate("gains", F.lit(0.0), lambda total, x: total + F.pow(F.lit(2.0), x - F.array_max("gains")), lambda total: F.log2(total / len(SHARES)))
    score = (F.col("score") + F.array_max("gains") + mean) / float(np.log2(10))
    return out.select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("n_common") + F.coalesce("known", F.lit(0)) + F.lit(int(n_train > 0))).alias("n_known"),
        F.lit(model.total).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("more", F.lit(0.0)) + end).alias("base_score"),
        score.alias("score"),
        (-score * float(np.log2(10)) / F.greatest("n_bytes", F.lit(1))).alias("bits_per_byte"),
    )


def op1_language_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_scores(table(spark, sf_dir, "documents").select("doc_id", "text"))
