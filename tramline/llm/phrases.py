"""Repeated-phrase automata: passages of words that recur anywhere go from every text.

Recurring windows are confirmed by counting; sharded Aho-Corasick automata are compiled from them, and every distinct
stretch of text that may hold one is streamed through its shard's automaton, which locates every occurrence.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tramline.llm.common import Scratch, cut, flat, keyed_texts, lists, mixed, same_doc, table
from tramline.llm.repeats import BASES, Rolling, covered, recurring, tokens_of, with_spans
from tramline.llm.shards import grid

WINDOW = 35
#: Words of an anchor.
GRAM = 6
#: Stretches and patterns that one automaton's task takes.
SHARD_STRETCHES, SHARD_PATTERNS = 8_000, 40_000
STRETCHES = "ah long, u long, copies long, kinds long, words array<int>"


def stretches(docs: DataFrame, distinct: DataFrame, window: int) -> DataFrame:
    """The words of each distinct block as 32-bit numbers."""
    wanted = distinct.groupBy("at.doc_id", "at.th").agg(F.collect_list(F.struct("ah", "u", "copies", "kinds", "at.s", "at.n")).alias("wanted"))

    def find(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in cut(batches):
            values, offsets = tokens_of(batch.column("text"), words=True)
            column = batch.column("wanted")
            blocks, owner = column.flatten(), np.repeat(np.arange(batch.num_rows), column.value_lengths().to_numpy())
            starts = offsets[owner] + blocks.field(4).to_numpy()
            sizes = blocks.field(5).to_numpy() - 1 + window
            at = np.repeat(starts - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())
            words = (values[at] >> np.uint64(32)).astype(np.uint32).view(np.int32)
            yield pa.RecordBatch.from_arrays([*(blocks.field(k) for k in range(4)), lists(words, sizes, pa.int32())], names=["ah", "u", "copies", "kinds", "words"])

    return same_doc(docs.select("doc_id", "th", "text"), wanted, "inner").mapInArrow(find, STRETCHES)


def confirmed(unlike: DataFrame, window: int) -> DataFrame:
    """(ah, u, offs): windows that occur twice or more, each under one stretch that holds it."""

    def find(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column("words")
            n = column.value_lengths().to_numpy() - window + 1
            if not len(n):
                continue
            first = np.cumsum(n + window - 1) - (n + window - 1)
            which = np.repeat(np.arange(len(n)), n)
            off = np.arange(len(which)) - np.repeat(np.cumsum(n) - n, n)
            values = mixed(column.flatten().to_numpy().view(np.uint32).astype(np.uint64))
            at = first[which] + off
            hashes = [Rolling(values, b)(at, at + window).view(np.int64) for b in BASES[2:4]]
            rows = batch.select(["ah", "u", "copies"]).take(pa.array(which))
            yield pa.RecordBatch.from_arrays([*map(pa.array, hashes), *rows.columns, pa.array(off.astype(np.int32))], names=["w1", "w2", "ah", "u", "copies", "off"])

    windows = unlike.mapInArrow(find, "w1 long, w2 long, ah long, u long, copies long, off int")
    met = windows.groupBy("w1", "w2").agg(F.sum("copies").alias("c"), F.min(F.struct("ah", "u", "off")).alias("at")).filter("c > 1")
    return met.groupBy("at.ah", "at.u").agg(F.collect_list("at.off").alias("offs"))


def numbers(column: pa.ChunkedArray) -> Iterator[tuple[int, ...]]:
    """Each row's words as a tuple of unsigned numbers."""
    for part in column.chunks:
        values = part.flatten().to_numpy().view(np.uint32).tolist()
        ends = np.cumsum(part.value_lengths().to_numpy()).tolist()
        for a, b in zip([0, *ends[:-1]], ends, strict=True):
            yield tuple(values[a:b])


def located(scratch: Scratch, units: DataFrame, patterns: DataFrame, window: int, n_units: int) -> DataFrame:
    """(ah, u, b, e): spans of each stretch that the automata of its shard cover."""
    shards = max(int(units.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-n_units // SHARD_STRETCHES))
    shard = F.expr(f"CAST(pmod(xxhash64(ah), {shards}) AS INT)").alias("shard")
    texts, keys = grid(
        scratch,
        units.select(shard, "ah", "u", "words"),
        patterns.select(shard, "u", "words", "offs"),
        ["shard"], SHARD_STRETCHES, SHARD_PATTERNS, ("u", "u"), ("1", "greatest(1, coalesce(size(offs), 1))"),
    )

    def scan(left: pa.Table, right: pa.Table) -> pa.Table:
        automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS, ahocorasick.KEY_SEQUENCE)
        for words, offs in zip(numbers(right.column("words")), right.column("offs").to_pylist(), strict=True):
            for key in [words] if offs is None else [words[k : k + window] for k in offs]:
                automaton.add_word(key, len(key))
        out: list[tuple] = []
        if len(automaton) and left.num_rows:
            automaton.make_automaton()
            for ah, u, words in zip(left.column("ah").to_pylist(), left.column("u").to_pylist(), numbers(left.column("words")), strict=True):
                begin = end = -1
                for last, size in automaton.iter(words):
                    b = last + 1 - size
                    if b > end or end < 0:
                        if end > 0:
                            out.append((ah, u, begin, end))
                        begin = b
                    begin, end = min(begin, b), last + 1
                if end > 0:
                    out.append((ah, u, begin, end))
        columns = list(zip(*out, strict=True)) or [()] * 4
        return pa.table({"ah": pa.array(columns[0], pa.int64()), "u": pa.array(columns[1], pa.int64()), "b": pa.array(columns[2], pa.int32()), "e": pa.array(columns[3], pa.int32())})

    cell = ["shard", "gl", "gr"]
    return texts.groupBy(*cell).cogroup(keys.groupBy(*cell)).applyInArrow(scan, "ah long, u long, b int, e int")


def phrase_spans(docs: DataFrame, scratch: Scratch, window: int, gram: int) -> DataFrame:
    """(doc_id, th, b, e): spans of words under recurring windows, of keyed_texts."""
    found, distinct = recurring(scratch, docs, window, gram, words=True)
    units = scratch.keep(stretches(docs, distinct, window), "units")
    offs = confirmed(units.filter("kinds > 1"), window)
    alike = units.filter("kinds = 1").select("ah", "u", "words", F.lit(None).cast("array<int>").alias("offs"))
    patterns = scratch.keep(alike.union(units.join(offs, ["ah", "u"]).select("ah", "u", "words", "offs")), "patterns")
    spans = located(scratch, units, patterns, window, units.count()).groupBy("ah", "u").agg(F.collect_set(F.struct("b", "e")).alias("spans"))
    met = found.join(scratch.keep(spans, "located"), ["ah", "u"]).select("doc_id", "th", "s", F.explode("spans").alias("x"))
    return met.selectExpr("doc_id", "th", "s + x.b AS b", "s + x.e AS e")


def phrase_dedup(docs: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """Each row of docs without the words that a recurring window covers.

    Returns doc_id, n_words, n_removed, kept (the other words, joined by a space) and the other columns in the struct
    `row`. Null text has no words; null ids are ids like others; repeated rows are separate places, so they repeat each
    other; texts shorter than a window stay whole.
    """
    docs = keyed_texts(docs, rest=True)
    scratch = Scratch(docs.sparkSession, "phrases")
    spans = phrase_spans(docs, scratch, window, min(gram, window))

    def remove(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in cut(batches):
            data, offsets = flat(batch.column("text"))
            out = []
            for k, found in enumerate(batch.column("spans").to_pylist()):
                words = data[offsets[k] : offsets[k + 1]].tobytes().split()
                kept = words
                if found:
                    gone = covered(found, len(words))
                    kept = [words[i] for i in np.flatnonzero(~gone)]
                out.append((len(words), len(words) - len(kept), b" ".join(kept)))
            n_words, n_removed, kept = zip(*out, strict=True)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(kept, pa.binary()).cast(pa.string()), batch.column("row")],
                names=["doc_id", "n_words", "n_removed", "kept", "row"],
            )

    row, doc_id = (docs.schema[c].dataType.simpleString() for c in ("row", "doc_id"))
    return with_spans(docs, spans).select("doc_id", "text", "spans", "row").mapInArrow(remove, f"doc_id {doc_id}, n_words long, n_removed long, kept string, row {row}")


def op5_repeated_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = phrase_dedup(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))
