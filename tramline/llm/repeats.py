"""Windows that recur anywhere in a corpus, found without a row for each window.

A window is `width` consecutive tokens of one document. It is named by its anchor, the first of its least-hashed grams
(runs of `gram` tokens): equal windows have equal anchors at equal places, so only windows with equal anchors need
comparing. Consecutive windows with one anchor form a block. Blocks whose whole tokens are alike need no closer look;
where blocks share an anchor and differ, their windows are compared one by one (see substrings and phrases).
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tramline.llm.common import Scratch, cut, flat, mixed, same_doc, tidy, within_task, word_bounds

BLOCKS = "ah long, u long, doc_id long, th binary, s int, n int"
#: Odd bases of the polynomial hashes, modulo 2**64.
BASES = tuple(int(x) | 1 for x in mixed(np.arange(1, 5, dtype=np.uint64)))
BYTE_VALUES = mixed(np.arange(256, dtype=np.uint64) + np.uint64(1000))


#: Powers that a task keeps for each base.
KEPT_POWERS = 1 << 20
_powers: dict[int, np.ndarray] = within_task()


def powers_of(base: int, n: int) -> np.ndarray:
    """The first n powers, modulo 2**64."""
    if n > KEPT_POWERS or base not in _powers:
        out = np.full(max(n, KEPT_POWERS), base, np.uint64)
        out[0] = 1
        np.multiply.accumulate(out, out=out)
        if n > KEPT_POWERS:
            return out
        _powers[base] = out
    return _powers[base][:n]


class Rolling:
    """Hashes of any run of tokens of one flat array."""

    def __init__(self, values: np.ndarray, base: int):
        n = len(values)
        powers, self.inverse = powers_of(base, n + 1), powers_of(pow(base, -1, 1 << 64), n + 1)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(values * powers[:-1], out=self.sums[1:])

    def __call__(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mixed((self.sums[ends] - self.sums[starts]) * self.inverse[starts] + (ends - starts).astype(np.uint64))

    def all(self, length: int) -> np.ndarray:
        """Of each run of this length."""
        n = len(self.sums) - length
        if n <= 0:
            return np.zeros(0, np.uint64)
        return mixed((self.sums[length:] - self.sums[:n]) * self.inverse[:n] + np.uint64(length))


def word_values(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word's bytes."""
    return Rolling(BYTE_VALUES[data], BASES[0])(starts, ends)


def tokens_of(column: pa.Array, words: bool) -> tuple[np.ndarray, np.ndarray]:
    """Hashed tokens (words or bytes) of all texts, and n + 1 offsets."""
    data, offsets = flat(column)
    if not words:
        return BYTE_VALUES[data], offsets
    starts, ends, at = word_bounds(data, offsets)
    return word_values(data, starts, ends), at


def least(keys: np.ndarray, width: int) -> np.ndarray:
    """Minima of each run of `width` keys, by minima from both ends of fixed pieces."""
    n = len(keys)
    if n < width:
        return np.zeros(0, keys.dtype)
    padded = np.full(-(-n // width) * width, np.iinfo(keys.dtype).max, keys.dtype)
    padded[:n] = keys
    pieces = padded.reshape(-1, width)
    up = np.minimum.accumulate(pieces, axis=1).ravel()
    down = np.minimum.accumulate(pieces[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(down[: n - width + 1], up[width - 1 : n])


def blocks_of(values: np.ndarray, offsets: np.ndarray, width: int, gram: int) -> tuple[np.ndarray, ...]:
    """Of each block: text number, first window, number of windows, anchor's hash, hash of the block's tokens.

    First windows count from the start of the flat array.
    """
    sizes = np.diff(offsets)
    none = (np.zeros(0, np.int64),) * 3 + (np.zeros(0, np.uint64),) * 2
    if not (sizes >= width).any():
        return none
    roll = Rolling(values, BASES[1])
    grams = roll.all(gram)
    low = np.uint64(0xFFFFFFFF)
    anchors = (least((grams & ~low) | np.arange(len(grams), dtype=np.uint64), width - gram + 1) & low).astype(np.int64)
    text = np.repeat(np.arange(len(sizes)), sizes)[: len(anchors)]
    valid = np.arange(len(anchors)) + width <= offsets[text + 1]
    anchors[~valid] = -1
    first = np.flatnonzero(np.concatenate(([True], (anchors[1:] != anchors[:-1]) | (text[1:] != text[:-1]))))
    count = np.diff(np.concatenate((first, [len(anchors)])))
    held = anchors[first] >= 0
    first, count = first[held], count[held]
    return text[first], first, count, grams[anchors[first]], roll(first, first + count - 1 + width)


def blocks(docs: DataFrame, width: int, gram: int, words: bool) -> DataFrame:
    """A row for each block of keyed_texts: its hashes, its text's key, its first window and number of windows."""

    @tidy
    def find(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in cut(batches):
            values, offsets = tokens_of(batch.column("text"), words)
            text, first, count, anchor, union = blocks_of(values, offsets, width, gram)
            rows = batch.select(["doc_id", "th"]).take(pa.array(text))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(anchor.view(np.int64)),
                    pa.array(union.view(np.int64)),
                    rows.column(0).cast(pa.int64()),
                    rows.column(1),
                    pa.array((first - offsets[text]).astype(np.int32)),
                    pa.array(count.astype(np.int32)),
                ],
                names=["ah", "u", "doc_id", "th", "s", "n"],
            )

    return docs.select("doc_id", "th", "text").mapInArrow(find, BLOCKS)


def recurring(scratch: Scratch, docs: DataFrame, width: int, gram: int, words: bool) -> tuple[DataFrame, DataFrame]:
    """Blocks whose anchor occurs twice or more; and a row for each distinct one of them.

    The second has (ah, u), a number `block`, the number of copies, `kinds` (how many distinct blocks share the anchor),
    and in `at` the text key and place of one copy. Counts are combined before each shuffle, so a common anchor makes few rows; the
    joins are of the kind whose large keys adaptive execution splits.
    """
    every = scratch.keep(blocks(docs, width, gram, words), "blocks")
    # kept, so that the join reads plain shuffles, whose large keys can be split; the same below
    anchors = scratch.keep(every.groupBy("ah").count().filter("count > 1").select("ah"), "anchors")
    found = scratch.keep(every.join(anchors, "ah", "left_semi"), "found")
    scratch.drop("blocks")
    kinds = found.groupBy("ah", "u").agg(F.count("*").alias("copies"), F.min(F.struct("doc_id", "th", "s", "n")).alias("at"))
    kinds = scratch.keep(kinds, "kinds")
    mixed_anchors = scratch.keep(kinds.groupBy("ah").agg(F.count("*").alias("kinds")), "mixed")
    distinct = scratch.keep(kinds.join(mixed_anchors, "ah").withColumn("block", F.monotonically_increasing_id()), "distinct")
    for name in ("anchors", "kinds", "mixed"):
        scratch.drop(name)
    return found, distinct


def spans_by_doc(spans: DataFrame) -> DataFrame:
    """(doc_id, th, b, e) rows to a list of spans for each text; no longer than the text's own list of blocks."""
    return spans.groupBy("doc_id", "th").agg(F.sort_array(F.collect_set(F.struct("b", "e"))).alias("spans"))


def with_spans(docs: DataFrame, spans: DataFrame) -> DataFrame:
    """Each text with the list of its spans, null without any."""
    return same_doc(docs, spans_by_doc(spans), "left")


def covered(spans: list | None, size: int) -> np.ndarray:
    """A flag for each token in any of the [b, e) spans."""
    step = np.zeros(size + 1, np.int64)
    if spans:
        edges = np.array([(x["b"], x["e"]) for x in spans])
        np.add.at(step, edges[:, 0], 1)
        np.add.at(step, edges[:, 1], -1)
    return np.cumsum(step[:-1]) > 0
