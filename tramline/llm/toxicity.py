"""Toxicity by subword-bag embeddings averaged into a linear softmax.

A word is the mean of the vectors of itself and its character n-grams (with the ends of the word), hashed to rows of one
table; a passage of words is the mean of its words; a linear softmax over it gives the classes. Table and softmax are trained jointly in numpy.
A misspelling shares most n-grams with the word it stands for, and so its vectors. A text is as toxic as its most toxic
passage, after a logistic calibration.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tramline.llm.common import cut, doc_texts, flat, id_crc32, mixed, others, table, tidy, unpacked, word_bounds
from tramline.llm.repeats import BASES, BYTE_VALUES, Rolling

BUCKETS, SIZE = 1 << 18, 8
GRAMS = (3, 4, 5, 6)
#: Words of a passage.
PASSAGE = 2
#: The classifier is fitted on a bounded sample of the labelled rows, in hashed order: rows of each label, and bytes (half for each label, and what the other leaves of its half).
SAMPLE_ROWS, SAMPLE_BYTES = 2500, 16_000_000
#: Longer texts, the shortest first, come into the sample after all others of their label.
SAMPLE_TEXT = 1_000_000
#: Passes over the sample: the first WARM_EPOCHS over all passages, the others over each text's TOP most toxic ones.
EPOCHS, WARM_EPOCHS, TOP, BATCH, RATE = 10, 1, 2, 2048, 0.04
#: Factor of the bag before the softmax, and the weight decay of the vectors.
SCALE, DECAY = 4.0, 1e-5
#: A subword that fewer texts of the sample have is unknown: words average their known subwords.
LEAST_DOCS = 3
#: Runs of bytes hashed at a time.
HASHED_RUNS = 1 << 18

#: Lower case for ASCII bytes; other bytes stay.
FOLD = np.arange(256, dtype=np.uint8)
FOLD[ord("A") : ord("Z") + 1] += 32


class Net(NamedTuple):
    """Each bucket's toxic-minus-clean logit (its vector times the softmax; NaN if unknown), the bias alike, and the calibration."""

    worth: np.ndarray
    base: float
    slope: float
    shift: float


def hashed(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: int) -> np.ndarray:
    """A hash of each run of bytes (in order of their starts), a stretch of the data at a time."""
    out = np.empty(len(starts), np.uint64)
    for lo in range(0, len(starts), HASHED_RUNS):
        a, b = starts[lo : lo + HASHED_RUNS], ends[lo : lo + HASHED_RUNS]
        first = a[0]
        out[lo : lo + HASHED_RUNS] = Rolling(BYTE_VALUES[FOLD[data[first : b.max()]]], base)(a - first, b - first)
    return out


def ranges(first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """first[i], first[i] + 1, ... (size[i] of them), for each i in turn."""
    return np.repeat(first - (np.cumsum(size) - size), size) + np.arange(size.sum())


def subwords(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of each word's subwords and their number by word: the word, and its byte n-grams, a space at either end included."""
    size = ends - starts + 2
    # the words alone, side by side
    flat_ = np.full(size.sum(), ord(" "), np.uint8)
    flat_[ranges(np.cumsum(size) - size + 1, size - 2)] = data[ranges(starts, size - 2)]
    ends = np.cumsum(size)
    starts = ends - size
    per = [np.ones(len(size), np.int64), *(np.maximum(size - g + 1, 0) for g in GRAMS)]
    number = np.sum(per, axis=0)
    first = np.cumsum(number) - number
    out = np.empty(int(number.sum()), np.int32)
    for k, own in enumerate(per):
        which = np.repeat(np.arange(len(size)), own)
        j = np.arange(len(which)) - np.repeat(np.cumsum(own) - own, own)
        a = starts[which] + j
        b = ends[which] if k == 0 else a + GRAMS[k - 1]
        key = hashed(flat_, a, b, BASES[3])
        out[first[which] + j] = ((key if k else mixed(key)) & np.uint64(BUCKETS - 1)).astype(np.int32)
        first = first + own
    return out, number


def distinct_words(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of one word of each kind, and each word's kind."""
    _, first, kind = np.unique(hashed(data, starts, ends, BASES[1]), return_index=True, return_inverse=True)
    return starts[first], ends[first], kind


def known_parts(parts: np.ndarray, number: np.ndarray, kind: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """A flag for each bucket: LEAST_DOCS texts or more have a subword in it."""
    first, seen = np.cumsum(number) - number, np.zeros(BUCKETS, np.int64)
    edges = np.flatnonzero(np.diff(doc, prepend=-1, append=-1))
    for lo, hi in zip(edges[:-1], edges[1:], strict=True):
        words = np.unique(kind[lo:hi])
        seen[np.unique(parts[ranges(first[words], number[words])])] += 1
    return seen >= LEAST_DOCS


def trained(data: np.ndarray, offsets: np.ndarray, labels: np.ndarray, seed: int = 0) -> Net:
    """Adam over passages of the sample's texts, each with its text's label; both labels weigh alike.

    A toxic text has clean passages too, so after WARM_EPOCHS over all passages each epoch takes the TOP passages of
    each text that the net so far finds most toxic.
    """
    rng = np.random.default_rng(seed)
    vectors = rng.normal(0, 0.1, (BUCKETS, SIZE)).astype(np.float32)
    softmax = rng.normal(0, 0.1, (SIZE, 2)).astype(np.float32)
    bias = np.zeros(2, np.float32)
    starts, ends, at = word_bounds(data, offsets)
    if not len(starts) or labels.min() == labels.max():
        return Net(np.zeros(BUCKETS), 4.0 if len(labels) and labels.mean() > 0.5 else -4.0, 1.0, 0.0)
    a, b, kind = distinct_words(data, starts, ends)
    parts, number = subwords(data, a, b)
    doc = np.repeat(np.arange(len(labels)), np.diff(at))
    known = known_parts(parts, number, kind, doc)
    held = known[parts]
    number = np.diff(np.append(0, np.cumsum(held))[np.append(0, np.cumsum(number))])
    parts = parts[held]
    part_at = np.cumsum(number) - number
    filled = np.flatnonzero(number)
    del held
    share = np.array([1 / max(1, (labels == k).sum()) for k in (0, 1)])
    moments = [np.zeros_like(x) for x in (vectors, vectors, softmax, softmax, bias, bias)]
    t = 0
    for epoch in range(EPOCHS):
        shift = rng.integers(PASSAGE, size=len(labels))  # other passages in each epoch
        passage = (np.arange(len(kind)) - at[doc] + shift[doc]) // PASSAGE
        begin = np.flatnonzero(np.diff(passage, prepend=-1) | np.diff(doc, prepend=-1))
        size = np.diff(np.append(begin, len(kind)))
        owner = doc[begin]
        if epoch >= WARM_EPOCHS:
            worth = vectors @ (softmax[:, 1] - softmax[:, 0])
            word = np.zeros(len(number))
            if len(filled):
                word[filled] = np.add.reduceat(worth[parts], part_at[filled]) / number[filled]
            value = np.add.reduceat(word[kind], begin) / size
            rank = np.lexsort((-value, owner))
            place = np.arange(len(rank)) - np.searchsorted(owner, owner)[rank]
            taken = rank[place < TOP]
        else:
            taken = np.arange(len(begin))
        order = rng.permutation(taken)
        truth = labels[owner]
        weight = share[truth] / np.bincount(owner[taken], minlength=len(labels))[owner]
        weight *= len(order) / weight[order].sum()
        for lo in range(0, len(order), BATCH):
            t += 1
            rows = order[lo : lo + BATCH]
            width = size[rows]
            own = np.repeat(np.arange(len(rows)), width)
            kinds, back = np.unique(kind[ranges(begin[rows], width)], return_inverse=True)
            n = number[kinds]
            sub = parts[ranges(part_at[kinds], n)]
            of = np.repeat(np.arange(len(kinds)), n)
            n = np.maximum(n, 1)
            words = np.stack([np.bincount(of, vectors[sub, k], len(kinds)) for k in range(SIZE)], axis=1) / n[:, None]
            bag = np.add.reduceat(words[back], np.cumsum(width) - width) / width[:, None]
            logits = SCALE * (bag @ softmax) + bias
            p = np.exp(logits - logits.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            p[np.arange(len(rows)), truth[rows]] -= 1
            p *= (weight[rows] / len(rows))[:, None]
            to_bag = SCALE * (p @ softmax.T) / width[:, None]
            to_word = np.stack([np.bincount(back, to_bag[own, k], len(kinds)) for k in range(SIZE)], axis=1) / n[:, None]
            used, again = np.unique(sub, return_inverse=True)
            wide = to_word[of]
            to_vector = np.stack([np.bincount(again, wide[:, k], len(used)) for k in range(SIZE)], axis=1) + DECAY * vectors[used]
            rate = RATE * (1 - (epoch * len(order) + lo) / (EPOCHS * len(order)))
            for k, (what, at_, grad) in enumerate(((vectors, used, to_vector), (softmax, slice(None), SCALE * bag.T @ p), (bias, slice(None), p.sum(axis=0)))):
                m, v = moments[2 * k], moments[2 * k + 1]
                m[at_] = 0.9 * m[at_] + 0.1 * grad
                v[at_] = 0.99 * v[at_] + 0.01 * grad * grad
                what[at_] -= rate * (m[at_] / (1 - 0.9**t)) / (np.sqrt(v[at_] / (1 - 0.99**t)) + 1e-8)
    del moments
    worth = np.where(known, SCALE * (vectors @ (softmax[:, 1] - softmax[:, 0])), np.nan).astype(np.float64)
    net = Net(worth, float(bias[1] - bias[0]), 1.0, 0.0)
    steps = np.append(np.arange(0, len(labels), 200), len(labels))
    x = [peaks(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], net) for i, j in zip(steps[:-1], steps[1:], strict=True)]
    return calibrated(net, np.concatenate(x), labels)


def calibrated(net: Net, x: np.ndarray, labels: np.ndarray) -> Net:
    """Fits score = sigmoid(slope * peak + shift) to the sample by Newton steps with a small ridge."""
    mean, spread = x.mean(), x.std() + 1e-9
    design = np.stack(((x - mean) / spread, np.ones(len(x))), axis=1)
    w = np.zeros(2)
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(design @ w, -30, 30)))
        grad = design.T @ (p - labels) + 0.1 * w
        w -= np.linalg.solve((design * (p * (1 - p))[:, None]).T @ design + 0.1 * np.eye(2), grad)
    return net._replace(slope=float(w[0] / spread), shift=float(w[1] - w[0] * mean / spread))


def peaks(data: np.ndarray, offsets: np.ndarray, net: Net) -> np.ndarray:
    """Of each text, the largest toxic-minus-clean logit of any PASSAGE consecutive words (all words of a shorter text)."""
    starts, ends, at = word_bounds(data, offsets)
    n = len(offsets) - 1
    base = net.base
    if not len(starts):
        return np.full(n, base)
    a, b, kind = distinct_words(data, starts, ends)
    sub, number = subwords(data, a, b)
    which = np.repeat(np.arange(len(number)), number)
    known = ~np.isnan(net.worth[sub])
    word = (np.bincount(which[known], net.worth[sub[known]], len(number)) / np.maximum(np.bincount(which[known], minlength=len(number)), 1))[kind]
    sums = np.concatenate(([0.0], np.cumsum(word)))
    size = np.diff(at)
    windows = np.maximum(size - PASSAGE + 1, np.minimum(size, 1))
    which = np.repeat(np.arange(n), windows)
    first = at[which] + np.arange(len(which)) - np.repeat(np.cumsum(windows) - windows, windows)
    width = np.minimum(size[which], PASSAGE)
    logit = (sums[first + width] - sums[first]) / width
    out = np.full(n, base)
    filled = np.flatnonzero(windows)
    out[filled] = base + np.maximum.reduceat(logit, (np.cumsum(windows) - windows)[filled])
    return out


def sampled(docs: DataFrame, labels: DataFrame, held_out: str) -> DataFrame:
    """doc_id, text and toxic of the bounded sample of the labelled rows that are not held out.

    A long text takes no other's place, nor one label the other's; the first of each label is in whatever its length.
    Of a repeated doc_id one row, the shortest, can be in it.
    """
    known = labels.filter("toxic IS NOT NULL AND doc_id IS NOT NULL").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    known = known.withColumn("crc", id_crc32(F.col("doc_id"))).filter(f"NOT ({held_out})")
    texts = docs.withColumn("key", F.struct(F.octet_length("text").alias("size"), F.xxhash64("text").alias("th")))
    rows = texts.join(known, "doc_id").groupBy("doc_id").agg(F.min("key").alias("key"), F.first("toxic").alias("toxic"))
    rows = rows.withColumn("turn", F.xxhash64("doc_id")).withColumn("size", F.col("key.size"))
    order = [F.greatest("size", F.lit(SAMPLE_TEXT)), "turn", "doc_id"]
    picked = [rows.filter(F.col("toxic") == k).orderBy(*order).limit(SAMPLE_ROWS) for k in (0, 1)]
    running = Window.partitionBy("toxic").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)  # over the bounded sample
    sample = picked[0].union(picked[1]).withColumn("run", F.sum("size").over(running)).withColumn("nth", F.count("*").over(running))
    # what the other label leaves of its half is free
    sample = sample.withColumn("other", F.sum("size").over(Window.partitionBy()) - F.sum("size").over(Window.partitionBy("toxic")))
    sample = sample.filter((F.col("run") <= F.greatest(F.lit(SAMPLE_BYTES // 2), SAMPLE_BYTES - F.col("other"))) | (F.col("nth") == 1))
    return texts.join(F.broadcast(sample.select("doc_id", "key", "toxic")), ["doc_id", "key"]).select("doc_id", "text", "toxic").dropDuplicates(["doc_id"])


def fitted(docs: DataFrame, labels: DataFrame, held_out: str) -> Net:
    """Trains on the bounded sample of the labelled rows that are not held out."""

    @tidy
    def train(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        if held:
            rows = pa.Table.from_batches(held).sort_by([("doc_id", "ascending"), ("text", "ascending")])
            data, offsets = flat(rows.column("text").combine_chunks())
            net = trained(data, offsets, rows.column("toxic").to_numpy().astype(np.int64))
            yield pa.RecordBatch.from_arrays([pa.array([x], k) for x, k in zip((net.worth.tobytes(), *net[1:]), (pa.binary(), *[pa.float64()] * 3), strict=True)], names=["worth", "base", "slope", "shift"])

    # one task holds the sample, which is bounded; the driver gets the numbers of Net alone
    found = sampled(docs, labels, held_out).repartition(1).mapInArrow(train, "worth binary, base double, slope double, shift double").first()
    if found is None:
        return trained(np.zeros(0, np.uint8), np.zeros(1, np.int64), np.zeros(0, np.int64))
    return Net(np.frombuffer(found["worth"], np.float64), found["base"], found["slope"], found["shift"])


def scored(rows: DataFrame, net: Net, columns: list[str]) -> DataFrame:
    """`columns` of rows, with score and predicted."""
    held = rows.sparkSession.sparkContext.broadcast(net)

    @tidy
    def score(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = held.value
        for batch in cut(batches):
            x = peaks(*flat(batch.column("text")), own)
            p = 1 / (1 + np.exp(-np.clip(own.slope * x + own.shift, -30, 30)))
            out = batch.select(columns)
            yield pa.RecordBatch.from_arrays([*out.columns, pa.array(p), pa.array((p >= 0.5).astype(np.int32))], names=[*columns, "score", "predicted"])

    kinds = ", ".join(f"{c} {rows.schema[c].dataType.simpleString()}" for c in columns)
    return rows.select(*dict.fromkeys([*columns, "text"])).mapInArrow(score, f"{kinds}, score double, predicted int")


def toxic_scores(docs: DataFrame, labels: DataFrame, held_out: str = "crc % 5 = 0") -> DataFrame:
    """doc_id, held_out, score and predicted for each row of docs.

    held_out is SQL over `crc`, the CRC-32 of the id as text (a null id: of empty text). Null text counts as empty, and
    has the score of no words. Labels that disagree count as toxic; null ones don't count. Without labels of both kinds
    every score is that of the only one, or near 0. Repeated rows score alike.
    """
    rows = doc_texts(docs).withColumn("crc", id_crc32(F.col("doc_id"))).withColumn("held_out", F.expr(held_out))
    return scored(rows, fitted(rows.select("doc_id", "text"), labels, held_out), ["doc_id", "held_out"])


def without_toxic(docs: DataFrame, labels: DataFrame, held_out: str = "crc % 5 = 0") -> DataFrame:
    """The rows of docs that aren't predicted toxic, unchanged."""
    net = fitted(doc_texts(docs), labels, held_out)
    rows = docs.select(F.coalesce("text", F.lit("")).alias("text"), F.struct(*others(docs)).alias("row"))  # the text once
    return unpacked(scored(rows, net, ["text", "row"]).filter("predicted = 0"), docs)


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxic_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
