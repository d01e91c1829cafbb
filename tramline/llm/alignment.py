"""Alignment of two tokenizers by a dictionary of token groups.

Where tokens of both end at the same byte, the text is cut into groups; the links of a group are all its pairs of an A
and a B token. Texts are worked on in blocks. A block interns its distinct groups, and expands the links of each just
once: for the number of its documents that hold each pair of ids, and, corpus-wide, for what a group's links add up to.
The sums are joined back to the blocks by group key, and to the documents by the group's number in its block.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from itertools import chain, islice
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tramline.llm.byte_bpe import STEP, ByteBpe, merges_file, ranges
from tramline.llm.common import Scratch, cut, doc_texts, table

FILE_A, FILE_B = "byte_bpe_50k.json", "piece_bpe_32k.model"
BLANK = "▁"
#: A space and what follows, up to the next space after a character that isn't white space.
UNIT = re.compile(r" \s*+(?:\S++(?:[^\S ]\s*+)?)*+")
#: What a row of a block's table holds.
DOC, GROUP, PAIR = 0, 1, 2
HALF = np.uint64(32)


class Pieces:
    """A piece model: ids of texts, and the bytes that each id stands for."""

    def __init__(self, model: bytes):
        from sentencepiece import SentencePieceProcessor

        self.model = SentencePieceProcessor(model_proto=model)
        entries = [self.entry(i) for i in range(self.model.get_piece_size())]
        self.sizes = np.array([len(x) for x in entries], np.int64)
        self.starts, self.data = np.cumsum(self.sizes) - self.sizes, np.frombuffer(b"".join(entries), np.uint8)
        plain = [self.model.id_to_piece(i) for i in range(len(entries)) if not self.model.is_control(i) and not self.model.is_unknown(i)]
        #: No piece goes on past the end of a word, so that words can be encoded each by itself.
        self.by_word = not any(BLANK in x.lstrip(BLANK) for x in plain)

    def entry(self, i: int) -> bytes:
        piece = self.model.id_to_piece(i)
        return bytes([int(piece[3:-1], 16)]) if self.model.is_byte(i) else piece.replace(BLANK, " ").encode()

    def encoded(self, units: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all units in a row, and n + 1 offsets. A unit's first character is the space that the model itself puts there."""
        lists = self.model.encode([x[1:] for x in units], num_threads=1)
        blank = [self.model.piece_to_id(BLANK)]
        lists = [ids if ids or unit != " " else blank for ids, unit in zip(lists, units, strict=True)]
        sizes = np.array([0, *map(len, lists)], np.int64)
        return np.fromiter(chain.from_iterable(lists), np.int32, int(sizes.sum())), np.cumsum(sizes)


_pieces: dict[str, Pieces] = {}


def opened(model: bytes) -> Pieces:
    """One model for each worker process."""
    key = hashlib.sha256(model).hexdigest()
    if key not in _pieces:
        _pieces.clear()
        _pieces[key] = Pieces(model)
    return _pieces[key]


def distinct_units(texts: list[str], by_word: bool) -> tuple[list[str], np.ndarray, np.ndarray]:
    """The distinct units of a space and each text, the unit numbers of all texts in a row, and n + 1 offsets. Empty texts have none."""
    parts, counts = [[]], [0]
    for text in texts:
        if by_word and len(text) > STEP:
            found, n = (m.group() for m in UNIT.finditer(f" {text}")), 0
            while units := list(islice(found, STEP)):
                parts += [units, []]
                n += len(units)
        else:
            units = [] if text == "" else UNIT.findall(f" {text}") if by_word else [f" {text}"]
            parts[-1] += units
            n = len(units)
        counts.append(n)
    # Arrow holds the units of a very long text more tightly than a list of strings does
    codes = pa.chunked_array([pa.array(x, pa.large_string()) for x in parts]).combine_chunks().dictionary_encode()
    return codes.dictionary.to_pylist(), codes.indices.to_numpy(zero_copy_only=False).astype(np.int64), np.cumsum(counts)


def by_bytes(units: list[str], lengths: np.ndarray, bpe: ByteBpe) -> tuple[np.ndarray, np.ndarray]:
    """bpe.encoded(units), but in one match of all units that don't end in white space, as those after them then begin anew."""
    blank = np.array([x[-1:].isspace() for x in units], bool)
    if blank.all():
        return bpe.encoded(units)
    joined, _ = bpe.encoded(["".join([x for x, b in zip(units, blank.tolist(), strict=True) if not b])])
    rest, off_rest = bpe.encoded([x for x, b in zip(units, blank.tolist(), strict=True) if b])
    counts = np.zeros(len(units), np.int64)
    counts[~blank] = np.diff(np.searchsorted(np.cumsum(bpe.sizes[joined]), np.cumsum(lengths[~blank]), side="right"), prepend=0)
    counts[blank] = np.diff(off_rest)
    ids, own = np.empty(len(joined) + len(rest), np.int32), np.repeat(blank, counts)
    ids[~own], ids[own] = joined, rest
    return ids, np.concatenate(([0], np.cumsum(counts)))


def spelt(ids: np.ndarray, offsets: np.ndarray, tokens: ByteBpe | Pieces, whole: bytes, ends: np.ndarray) -> np.ndarray:
    """Which units (`whole`, ending at `ends` behind a first 0) their tokens spell byte for byte."""
    sizes = tokens.sizes[ids]
    good = np.diff(np.concatenate(([0], np.cumsum(sizes)))[offsets]) == np.diff(ends)
    keep = np.repeat(good, np.diff(offsets))
    data = tokens.data[ranges(tokens.starts[ids[keep]], sizes[keep])]
    expected = np.frombuffer(whole, np.uint8)[np.repeat(good, np.diff(ends))]
    wrong = np.concatenate(([0], np.cumsum(data != expected)))
    bounds = np.concatenate(([0], np.cumsum(np.diff(ends)[good])))
    good[np.flatnonzero(good)] = wrong[bounds[1:]] == wrong[bounds[:-1]]
    return good


class Block(NamedTuple):
    """Groups of some texts. Per text: tokens of A and B, groups, links, digest, and n + 1 offsets into `group` and `uses`."""

    n_a: np.ndarray
    n_b: np.ndarray
    n_groups: np.ndarray
    n_links: np.ndarray
    digests: list[str]
    offsets: np.ndarray
    group: np.ndarray
    uses: np.ndarray
    keys: list[bytes]
    pairs: np.ndarray
    docs: np.ndarray


def key_ids(key: bytes) -> tuple[np.ndarray, np.ndarray]:
    """The A and B ids of a group key: the number of A ids, these, and the B ids, as 32-bit numbers."""
    numbers = np.frombuffer(key, "<i4")
    return numbers[1 : 1 + numbers[0]], numbers[1 + numbers[0] :]


def key_links(key: bytes) -> list[tuple[int, int, int]]:
    """(A id, B id, links) of a group: each distinct pair once."""
    a, b = (Counter(x.tolist()) for x in key_ids(key))
    return [(i, j, m * n) for i, m in a.items() for j, n in b.items()]


def interned(ids_a: np.ndarray, ids_b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray) -> tuple[np.ndarray, list[bytes]]:
    """Each group's number among the distinct ones, and their keys."""
    at_a, at_b = np.cumsum(n_a) - n_a, np.cumsum(n_b) - n_b
    out = np.empty(len(n_a), np.int64)
    simple = (n_a == 1) & (n_b == 1)
    codes, out[simple] = np.unique(ids_a[at_a[simple]].astype(np.uint64) << HALF | ids_b[at_b[simple]].astype(np.uint64), return_inverse=True)
    packed = np.ones((len(codes), 3), "<i4")
    packed[:, 1], packed[:, 2] = codes >> HALF, codes & np.uint64(0xFFFFFFFF)
    raw = packed.tobytes()
    keys = [raw[i : i + 12] for i in range(0, len(raw), 12)]
    known: dict[bytes, int] = {}
    others = np.flatnonzero(~simple)
    a, b = ids_a.astype("<i4").tobytes(), ids_b.astype("<i4").tobytes()
    heads = n_a[others].astype("<i4").tobytes()
    spans = zip(*[(4 * x[others]).tolist() for x in (at_a, at_a + n_a, at_b, at_b + n_b)], strict=True)
    out[others] = [known.setdefault(heads[4 * k : 4 * k + 4] + a[s:t] + b[u:v], len(known)) for k, (s, t, u, v) in enumerate(spans)]
    out[others] += len(keys)
    return out, keys + list(known)


def totals(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sums of the values between one offset and the next."""
    return np.diff(np.concatenate(([0], np.cumsum(values)))[offsets])


def aligned(texts: list[str], bpe: ByteBpe, pieces: Pieces, by_word: bool = False) -> Block:
    """Aligns texts. Empty ones, and those that either tokenizer doesn't spell as a space and the text, have no tokens.

    by_word: each distinct unit (a word with the white space before it) is encoded and aligned once, and texts are put
    together from units. That is right where no token of either goes on from another character to a space.
    """
    n = len(texts)
    units, unit, starts = distinct_units(texts, by_word)
    raw = [x.encode() for x in units]
    whole, ends = b"".join(raw), np.cumsum([0, *map(len, raw)])
    (a, off_a), (b, off_b) = by_bytes(units, np.diff(ends), bpe) if by_word else bpe.encoded(units), pieces.encoded(units)
    good = spelt(a, off_a, bpe, whole, ends) & spelt(b, off_b, pieces, whole, ends)
    a, b = a[np.repeat(good, np.diff(off_a))], b[np.repeat(good, np.diff(off_b))]
    lengths = np.where(good, np.diff(ends), 0)
    # both tokenizers' ends as byte offsets; a group ends where both do, as they do at each unit's end
    end_a, end_b = np.cumsum(bpe.sizes[a]), np.cumsum(pieces.sizes[b])
    mark = np.zeros(int(lengths.sum()) + 1, np.uint8)
    mark[end_a] = 1
    mark[end_b] |= 2
    number = np.cumsum(mark == 3)
    total = int(number[-1])
    n_a, n_b = np.bincount(number[end_a - 1], minlength=total), np.bincount(number[end_b - 1], minlength=total)
    last = number[np.cumsum(lengths)]
    first = np.concatenate(([0], last))[:-1].astype(np.int64)
    group, keys = interned(a, b, n_a, n_b)
    names = ["{}|{}".format(*(",".join(map(str, x.tolist())) for x in key_ids(k))) for k in keys]
    spans = zip(first.tolist(), last.tolist(), strict=True)
    numbers = group.tolist()
    names = [";".join([names[g] for g in numbers[s:e]]) for s, e in spans]  # of each unit
    # from units to texts
    whole_text = totals(~good[unit], starts) == 0
    unit = unit[np.repeat(whole_text, np.diff(starts))]
    starts = np.concatenate(([0], np.cumsum(np.where(whole_text, np.diff(starts), 0))))
    spans, numbers = zip(starts[:-1].tolist(), starts[1:].tolist(), strict=True), unit.tolist()
    digests = [hashlib.sha256(";".join([names[u] for u in numbers[s:e]]).encode()).hexdigest() if e > s else "" for s, e in spans]
    links = totals(n_a * n_b, np.concatenate(([0], last)))
    counts = [totals(x[unit], starts) for x in (np.diff(off_a), np.diff(off_b), last - first, links)]
    group = group[ranges(first[unit], (last - first)[unit])]
    of = np.repeat(np.arange(n), counts[2])
    seen, uses = np.unique(of * max(1, len(keys)) + group, return_counts=True)
    of, group = np.divmod(seen, max(1, len(keys)))
    # the links of each distinct group once, then the distinct pairs of each text
    held = [key_links(k) for k in keys]
    sizes = np.array([len(x) for x in held], np.int64)
    flat = np.fromiter((i << 32 | j for x in held for i, j, _ in x), np.uint64, int(sizes.sum()))
    pairs, pair = np.unique(flat, return_inverse=True)
    by_text = np.repeat(of, sizes[group]) * max(1, len(pairs)) + pair[ranges((np.cumsum(sizes) - sizes)[group], sizes[group])]
    docs = np.bincount(np.unique(by_text) % max(1, len(pairs)), minlength=len(pairs))
    return Block(*counts, digests, np.searchsorted(of, np.arange(n + 1)), group, uses, keys, pairs, docs)


def block_rows(docs: DataFrame, bpe: ByteBpe, model: bytes, by_word: bool) -> DataFrame:
    """Three kinds of rows for each block of texts: its documents, its distinct groups, and how many documents hold each pair."""
    rows = doc_texts(docs)
    held = rows.sparkSession.sparkContext.broadcast((bpe, model))  # as large as the vocabulary files
    kind = rows.schema["doc_id"].dataType.simpleString()
    schema = f"kind int, block long, doc_id {kind}, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, groups array<int>, uses array<int>, k int, key binary, a int, b int, docs long"
    columns = ("kind", "block", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "groups", "uses", "k", "key", "a", "b", "docs")
    kinds = {"kind": pa.int32(), "block": pa.int64(), "n_a": pa.int64(), "n_b": pa.int64(), "n_groups": pa.int64(), "n_links": pa.int64(), "groups_sha256": pa.string()}
    kinds |= {"groups": pa.list_(pa.int32()), "uses": pa.list_(pa.int32()), "k": pa.int32(), "key": pa.binary(), "a": pa.int32(), "b": pa.int32(), "docs": pa.int64()}

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe, model = held.value
        bpe, pieces, number = bpe.kept(), opened(model), TaskContext.get().partitionId() << 32
        if by_word and not pieces.by_word:
            raise ValueError("the model has pieces that go on past the end of a word")
        for batch in cut(batches):
            x, ids = aligned(batch.column("text").to_pylist(), bpe, pieces, by_word), batch.column("doc_id")

            def rows(kind: int, n: int, number: int = number, ids: pa.Array = ids, **own: object) -> pa.RecordBatch:
                own |= {"kind": np.full(n, kind), "block": np.full(n, number)}
                made = [own[c] if isinstance(own.get(c), pa.Array) else pa.array(own[c], kinds[c]) if c in own else pa.nulls(n, ids.type if c == "doc_id" else kinds[c]) for c in columns]
                return pa.RecordBatch.from_arrays(made, names=list(columns))

            def lists(values: np.ndarray, offsets: np.ndarray = x.offsets) -> pa.ListArray:
                return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values, pa.int32()))

            yield rows(DOC, len(ids), doc_id=ids, n_a=x.n_a, n_b=x.n_b, n_groups=x.n_groups, n_links=x.n_links, groups_sha256=x.digests, groups=lists(x.group), uses=lists(x.uses))
            yield rows(GROUP, len(x.keys), k=np.arange(len(x.keys)), key=x.keys)
            yield rows(PAIR, len(x.pairs), a=x.pairs >> HALF, b=x.pairs & np.uint64(0xFFFFFFFF), docs=x.docs)
            number += 1

    return rows.mapInArrow(run, schema)


def pair_counts(blocks: DataFrame) -> DataFrame:
    """(a, b, docs, best): how many documents hold each linked pair, and whether no pair of its A id is in more.

    The best count of each A id is a table as large as A's vocabulary at most, so it is broadcast.
    """
    pairs = blocks.filter(F.col("kind") == PAIR).groupBy("a", "b").agg(F.sum("docs").alias("docs"))
    most = pairs.groupBy("a").agg(F.max("docs").alias("_most"))
    return pairs.join(F.broadcast(most), "a").select("a", "b", "docs", (F.col("docs") == F.col("_most")).cast("long").alias("best"))


def group_sums(blocks: DataFrame, pairs: DataFrame) -> DataFrame:
    """(key, n_best, count_sum) of each distinct group of the corpus, from its links, expanded once."""

    def expand(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column("key").to_pylist()
            links = [key_links(k) for k in keys]
            numbers = np.array([y for x in links for y in x], np.int64).reshape(-1, 3)
            of = np.repeat(np.arange(len(keys)), [len(x) for x in links])
            yield pa.RecordBatch.from_arrays([batch.column("key").take(pa.array(of)), pa.array(numbers[:, 0], pa.int32()), pa.array(numbers[:, 1], pa.int32()), pa.array(numbers[:, 2])], names=["key", "a", "b", "links"])

    distinct = blocks.filter(F.col("kind") == GROUP).select("key").distinct()
    links = distinct.mapInArrow(expand, "key binary, a int, b int, links long").join(pairs, ["a", "b"])
    return links.groupBy("key").agg(F.sum(F.col("links") * F.col("best")).alias("n_best"), F.sum(F.col("links") * F.col("docs")).alias("count_sum"))


def alignment(docs: DataFrame, bpe: ByteBpe, model: bytes, by_word: bool = False) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum and groups_sha256 of each row.

    Null and empty texts, and those that either tokenizer doesn't spell byte for byte, have zeros and an empty digest.
    A row is a document, also where ids repeat or are null. An empty table gives an empty result; other columns than
    doc_id and text are not looked at. by_word: see aligned.
    """
    scratch = Scratch(docs.sparkSession, "alignment")
    blocks = scratch.keep(block_rows(docs, bpe, model, by_word), "blocks")
    pairs = scratch.keep(pair_counts(blocks), "pairs")
    sums = group_sums(blocks, pairs)
    found = blocks.filter(F.col("kind") == GROUP).select(F.col("block").alias("at"), "k", "key").join(sums, "key").select("at", "k", "n_best", "count_sum")
    own = blocks.filter(F.col("kind") == DOC).select("block", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "groups", "uses")
    names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]

    def added(texts: pa.Table, values: pa.Table) -> pa.Table:
        """A block's documents with what their groups add up to."""
        size = 1 + int(np.max(values.column("k").to_numpy(), initial=-1))
        lists = texts.column("groups").combine_chunks()
        group, uses = lists.flatten().to_numpy(zero_copy_only=False), texts.column("uses").combine_chunks().flatten().to_numpy(zero_copy_only=False)
        ends = np.concatenate(([0], np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False))))
        out = {c: texts.column(c) for c in names if c in texts.column_names}
        for c in ("n_best", "count_sum"):
            of = np.zeros(size, np.int64)
            of[values.column("k").to_numpy()] = values.column(c).to_numpy()
            sums = np.concatenate(([0], np.cumsum(of[group] * uses)))
            out[c] = pa.array(sums[ends[1:]] - sums[ends[:-1]])
        return pa.table({c: out[c] for c in names})

    kind = own.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
    return own.groupBy("block").cogroup(found.groupBy("at")).applyInArrow(added, schema)


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All whole texts by the two public tokenizers; see alignment. Their patterns and pieces begin anew at a space after a word."""
    import public_tokenizers

    with open(public_tokenizers.path(FILE_B), "rb") as f:
        model = f.read()
    return alignment(table(spark, sf_dir, "documents"), merges_file(public_tokenizers.path(FILE_A), public_tokenizers.PATTERN), model, by_word=True)
