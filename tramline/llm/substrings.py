"""Suffix-array dedup: long strings of tokens (bytes or words) that start in two places or more go from every text.

Suffixes that may begin a repeat are range-partitioned by their leading tokens at sampled splitters, sorted within each
bucket by multikey quicksort, and compared with their neighbours, across the buckets' boundaries too. A suffix's key is
its first eight bytes and two 64-bit hashes of its window's halves, so that a row stays small. Stretches of text whose
copies are alike as a whole are told by the hash of the stretch and need no sorting (see repeats).
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tramline.llm.common import Scratch, cut, flat, keyed_texts, same_doc, table, tidy, unpacked, word_bounds
from tramline.llm.repeats import BASES, BYTE_VALUES, Rolling, covered, recurring, with_spans, word_values

WIDTH = 400
#: Suffixes that one bucket sorts in memory (40 bytes each).
BUCKET_ROWS = 1_000_000
SUFFIXES = "lead long, h1 long, h2 long, block long, i int, once boolean"


def suffixes(docs: DataFrame, wanted: DataFrame, width: int, words: bool) -> DataFrame:
    """A row for each window of the wanted blocks: its first 8 bytes as a number in byte order, and hashes of its halves.

    In words, these are the first word's bytes, with zeros after a shorter word.
    """
    lists = wanted.groupBy("at.doc_id", "at.th").agg(F.collect_list(F.struct("block", "at.s", "at.n", (F.col("copies") == 1).alias("once"))).alias("wanted"))
    half = width // 2

    @tidy
    def find(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in cut(batches):
            data, offsets = flat(batch.column("text"))
            if words:
                starts, ends, offsets = word_bounds(data, offsets)
                values = word_values(data, starts, ends)
            else:
                values = BYTE_VALUES[data]
            roll = Rolling(values, BASES[2])
            column = batch.column("wanted")
            blocks, owner = column.flatten(), np.repeat(np.arange(batch.num_rows), column.value_lengths().to_numpy())
            block, s, n = (blocks.field(k).to_numpy() for k in range(3))
            which = np.repeat(np.arange(len(s)), n)
            i = s[which] + np.arange(len(which)) - np.repeat(np.cumsum(n) - n, n)
            at = offsets[owner[which]] + i
            first, size = (starts[at], ends[at] - starts[at]) if words else (at, np.full(len(at), width))
            lead = np.zeros(len(at), np.uint64)
            for k in range(8):
                inside = np.flatnonzero(size > k)
                lead[inside] |= data[first[inside] + k].astype(np.uint64) << np.uint64(56 - 8 * k)
            numbers = [(lead ^ np.uint64(1 << 63)).view(np.int64), *(x.view(np.int64) for x in (roll(at, at + half), roll(at + half, at + width)))]
            yield pa.RecordBatch.from_arrays(
                [*map(pa.array, numbers), pa.array(block[which]), pa.array(i.astype(np.int32)), blocks.field(3).take(pa.array(which))],
                names=["lead", "h1", "h2", "block", "i", "once"],
            )

    return same_doc(docs.select("doc_id", "th", "text"), lists, "inner").mapInArrow(find, SUFFIXES)


def multikey_order(columns: list[np.ndarray]) -> np.ndarray:
    """Order of rows by the columns: quicksort by the first, then only runs of equals by the next, and so on."""
    order = np.argsort(columns[0], kind="quicksort")
    run = np.zeros(len(order), np.int64)
    for k, column in enumerate(columns):
        if k:
            size = np.bincount(run)
            open_ = np.flatnonzero(size[run] > 1)
            inner = np.lexsort((column[order[open_]], run[open_]))
            order[open_] = order[open_[inner]]
        new = np.zeros(len(order), bool)
        new[1:] = column[order[1:]] != column[order[:-1]]
        if k:
            new[1:] |= run[1:] != run[:-1]
        run = np.cumsum(new)
    return order


def repeated_suffixes(rows: DataFrame, n_rows: int, scratch: Scratch) -> DataFrame:
    """(block, i) of the once-copied windows that equal another one."""
    buckets = max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-n_rows // BUCKET_ROWS))
    # the place is part of the sort key, so that splitters also divide a run of equal suffixes
    dealt = rows.repartitionByRange(buckets, "lead", "h1", "h2", "block", "i")

    @tidy
    def compare(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = pa.Table.from_batches(list(batches)) if (batches := [b for b in batches if b.num_rows]) else None
        if held is None:
            return
        keys = [held.column(k).to_numpy() for k in range(3)]
        order = multikey_order(keys)
        new = np.ones(len(order), bool)
        new[1:] = np.logical_or.reduce([k[order[1:]] != k[order[:-1]] for k in keys])
        run = np.cumsum(new) - 1
        alone = np.bincount(run)[run] == 1
        once = held.column("once").to_numpy()[order]
        edge = np.zeros(len(order), bool)
        edge[[0, -1]] = True  # the bucket's first and last suffix; equal ones next door have the same key
        told = ((~alone & once) | edge).nonzero()[0]
        out = held.take(pa.array(order[told]))
        for name, flags in (("edge", edge), ("repeat", ~alone & once), ("open", alone & once)):
            out = out.append_column(name, pa.array(flags[told]))
        yield from out.combine_chunks().to_batches()

    sorted_ = scratch.keep(dealt.mapInArrow(compare, f"{SUFFIXES}, edge boolean, repeat boolean, open boolean"), "sorted")
    key = ["lead", "h1", "h2"]
    edges = sorted_.filter("edge")
    across = edges.groupBy(*key).agg(F.count_distinct(F.struct("block", "i")).alias("places")).filter("places > 1").select(*key)
    met = edges.filter("open").join(across, key, "left_semi")
    return sorted_.filter("repeat").select("block", "i").union(met.select("block", "i"))


def runs_of(found: DataFrame, width: int) -> DataFrame:
    """(block, b, e): the spans under windows (block, i), a row for each run of neighbouring windows."""
    by = found.groupBy("block").agg(F.collect_set("i").alias("i"))
    # the lambdas take one argument only: Spark passes the place in the list as a second one
    first = F.sort_array(F.array_except("i", F.transform("i", lambda x: x + 1)))
    last = F.sort_array(F.array_except("i", F.transform("i", lambda x: x - 1)))
    return by.select("block", F.inline(F.arrays_zip(first.alias("b"), last.alias("e")))).selectExpr("block", "b", f"e + {width} AS e")


def repeated_spans(docs: DataFrame, scratch: Scratch, width: int, gram: int, words: bool) -> DataFrame:
    """(doc_id, th, b, e): spans of tokens under windows that also start elsewhere, of keyed_texts."""
    found, distinct = recurring(scratch, docs, width, gram, words)
    unlike = distinct.filter("kinds > 1")
    n_rows = unlike.agg(F.coalesce(F.sum("at.n"), F.lit(0))).first()[0]
    single = scratch.keep(runs_of(repeated_suffixes(suffixes(docs, unlike, width, words), n_rows, scratch), width), "runs")
    scratch.drop("sorted")
    single = single.join(unlike.select("block", "at.doc_id", "at.th"), "block").select("doc_id", "th", "b", "e")
    copied = found.join(distinct.filter("copies > 1").select("ah", "u"), ["ah", "u"], "left_semi")
    return copied.selectExpr("doc_id", "th", "s AS b", f"s + n - 1 + {width} AS e").union(single)


def substring_dedup(docs: DataFrame, width: int = WIDTH, gram: int | None = None, whole_characters: bool = False, words: bool = False) -> DataFrame:
    """Each row of docs without the bytes that a repeated string of `width` bytes (or words) covers.

    Returns doc_id, n_bytes, n_removed, n_spans, kept (binary), and the other columns in the struct `row`. Null text
    counts as empty; null ids are ids like others; repeated rows are separate places, so they repeat each other. Texts
    shorter than width stay whole; an empty table gives an empty result. whole_characters: a character stays whole
    unless all its bytes go. words: runs without white space are the tokens; the white space after a word goes with it.
    gram: tokens of an anchor (half the width; longer ones recur less by chance, shorter ones lie less densely).
    """
    docs = keyed_texts(docs, rest=True)
    scratch = Scratch(docs.sparkSession, "substrings")
    spans = repeated_spans(docs, scratch, width, gram or max(1, width // 2), words)
    row = docs.schema["row"]

    @tidy
    def remove(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in cut(batches):
            data, offsets = flat(batch.column("text"))
            starts, ends, at = word_bounds(data, offsets) if words else (None, None, None)
            out = []
            for k, found in enumerate(batch.column("spans").to_pylist()):
                own = data[offsets[k] : offsets[k + 1]]
                if words and found:
                    edges = np.append(starts[at[k] : at[k + 1]], ends[at[k + 1] - 1]) - offsets[k]
                    found = [{"b": edges[x["b"]], "e": edges[x["e"]]} for x in found]
                gone = covered(found, len(own))
                if whole_characters and found:
                    begins = np.flatnonzero((own & 0xC0) != 0x80)
                    gone = np.repeat(np.logical_and.reduceat(gone, begins), np.diff(np.append(begins, len(own))))
                n_spans = int(np.count_nonzero(gone[1:] & ~gone[:-1])) + int(len(gone) and gone[0])
                out.append((len(own), int(np.count_nonzero(gone)), n_spans, own[~gone].tobytes()))
            n_bytes, n_removed, n_spans, kept = zip(*out, strict=True)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(pa.array(x, pa.int64()) for x in (n_bytes, n_removed, n_spans)), pa.array(kept, pa.binary()), batch.column("row")],
                names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept", "row"],
            )

    return with_spans(docs, spans).select("doc_id", "text", "spans", "row").mapInArrow(
        remove, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, n_bytes long, n_removed long, n_spans long, kept binary, row {row.dataType.simpleString()}"
    )


def dedup_texts(docs: DataFrame, width: int = WIDTH, words: bool = False) -> DataFrame:
    """docs with each text cut (see substring_dedup); a text may become empty, no row goes, null text stays null."""
    cut_ = substring_dedup(docs, width, whole_characters=True, words=words)
    return unpacked(cut_.withColumn("kept", F.decode("kept", "UTF-8")), docs, "kept")


def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = substring_dedup(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
