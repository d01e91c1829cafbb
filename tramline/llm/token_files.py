"""Token counts from flat token files without an index.

A file is a run of fixed-size blocks of little-endian 16-bit token ids: each document's tokens, then the end-of-document
id. Blocks are cut with no regard to documents. Each block is searched on its own with numpy; a prefix scan over the
blocks' summaries then stitches the documents that cross boundaries.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tramline.llm.common import Scratch, cut, doc_texts, flat, table, tidy

#: Byte tokens: ids 0-255 are UTF-8 bytes, 256 ends a document.
END_ID = 256
BLOCK_TOKENS = 1 << 20
#: Documents whose ids one row of the list holds.
LIST_ROWS = 4096
#: Blocks that one group of the prefix scan holds.
SCAN_BLOCKS = 4096
#: Bytes of blocks that are written, read or given to a worker at once; a larger block is a step of its own.
STEP_BYTES = 8 << 20


def stored_by(block_tokens: int) -> dict[str, str]:
    """Options of Parquet for rows of whole blocks, so that a task holds STEP_BYTES of them at once.

    Otherwise a page takes 100 rows before its size is looked at, a row group is cut by its compressed size, and a reader
    makes batches of 4,096 rows, which may be all blocks of a task.
    """
    rows = max(1, STEP_BYTES // (2 * block_tokens))
    limits = {"parquet.block.size": STEP_BYTES, "parquet.block.row.count.limit": rows, "parquet.page.row.count.limit": max(1, rows // 8)}
    return {"parquet.enable.dictionary": "false", **{k: str(v) for k, v in limits.items()}}


def written(docs: DataFrame, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """(file, block, tokens, first, ids): a file for each task; rows with tokens are its blocks in order, rows with ids
    list its documents in order, from number `first`."""
    rows = doc_texts(docs).withColumn("doc_id", F.col("doc_id").cast("long"))

    def write(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        file, block, first = TaskContext.get().partitionId(), 0, 0
        rest, ids = np.zeros(0, "<u2"), []

        def row(tokens: bytes | None, listed: list | None) -> pa.RecordBatch:
            at = None if tokens is None else block
            number = None if listed is None else first
            kinds = [pa.int32(), pa.int64(), pa.binary(), pa.int64(), pa.list_(pa.int64())]
            return pa.RecordBatch.from_arrays([pa.array([x], k) for x, k in zip((file, at, tokens, number, listed), kinds, strict=True)], names=["file", "block", "tokens", "first", "ids"])

        for batch in cut(batches):
            data, offsets = flat(batch.column("text"))
            tokens = np.insert(data.astype("<u2"), offsets[1:], END_ID)
            rest = np.concatenate((rest, tokens))
            whole = len(rest) // block_tokens * block_tokens
            for at in range(0, whole, block_tokens):
                yield row(rest[at : at + block_tokens].tobytes(), None)
                block += 1
            rest = rest[whole:]
            ids += batch.column("doc_id").to_pylist()
            while len(ids) >= LIST_ROWS:
                yield row(None, ids[:LIST_ROWS])
                first, ids = first + LIST_ROWS, ids[LIST_ROWS:]
        if len(rest):
            yield row(rest.tobytes(), None)
        if ids:
            yield row(None, ids)

    return rows.mapInArrow(tidy(write), "file int, block long, tokens binary, first long, ids array<long>")


def scanned(blocks: DataFrame, end_id: int = END_ID) -> DataFrame:
    """Of each block: its size, the number of ends in it, the tokens before the first and after the last, and the sizes between."""

    def scan(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in cut(batches, "tokens"):
            out = []
            for x in batch.column("tokens"):
                tokens = np.frombuffer(x.as_buffer(), "<u2")
                ends = np.flatnonzero(tokens == end_id)
                head, tail = (int(ends[0]), len(tokens) - int(ends[-1]) - 1) if len(ends) else (len(tokens), len(tokens))
                out.append((len(ends), head, tail, np.diff(ends) - 1))
            n, head, tail, inner = zip(*out, strict=True)
            yield pa.RecordBatch.from_arrays(
                [batch.column("file"), batch.column("block"), *(pa.array(c, pa.int64()) for c in (n, head, tail)), pa.array(inner, pa.list_(pa.int64()))],
                names=["file", "block", "ends", "head", "tail", "inner"],
            )

    return blocks.select("file", "block", "tokens").mapInArrow(tidy(scan), "file int, block long, ends long, head long, tail long, inner array<long>")


def stitched(blocks: DataFrame, scratch: Scratch) -> DataFrame:
    """(file, number, n_tokens) of each document, from the blocks' summaries.

    The scan's state before a block is the number of ends so far and the tokens since the last one. It is summed within
    groups of SCAN_BLOCKS blocks, then over the groups, so that no window holds a large file's blocks.
    """
    group = (F.col("block") / SCAN_BLOCKS).cast("long")
    rows = scratch.keep(blocks.withColumn("part", group), "summaries", STEP_BYTES)
    # tokens since the last end, after a run of blocks: those after the latest block with an end
    last = F.max(F.when(F.col("ends") > 0, F.col("block")))
    parts = rows.groupBy("file", "part").agg(F.sum("ends").alias("ends"), last.alias("at"), F.sum("head").alias("size"))
    tails = rows.join(parts.select("file", "part", "at"), ["file", "part"]).filter("at IS NULL OR block >= at")
    tails = tails.groupBy("file", "part").agg(F.sum("tail").alias("open"), F.max(F.col("at").isNotNull()).alias("closed"))
    parts = parts.select("file", "part", "ends").join(tails, ["file", "part"])

    def before(order: str, by: list[str]):
        return Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)

    def carried(df: DataFrame, order: str, by: list[str], closed, tail, ends, start_ends, start_open) -> DataFrame:
        w = before(order, by)
        run = F.coalesce(F.sum(closed.cast("long")).over(w), F.lit(0))
        df = df.withColumn("_run", run)
        own = Window.partitionBy(*by, "_run").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
        # rows of one _run: the closing block itself comes last in the run before, so its tail starts this one
        behind = F.coalesce(F.sum(F.when(~closed, tail)).over(own), F.lit(0))
        opener = F.coalesce(F.max(F.when(closed, F.struct(F.col(order), tail.alias("tail")))).over(w)["tail"], start_open)
        return df.withColumn("_ends", F.coalesce(F.sum(ends).over(w), F.lit(0)) + start_ends).withColumn("_open", behind + opener).drop("_run")

    zero = F.lit(0)
    parts = carried(parts, "part", ["file"], F.col("closed"), F.col("open"), F.col("ends"), zero, zero)
    parts = parts.select("file", "part", F.col("_ends").alias("ends_0"), F.col("_open").alias("open_0"))
    rows = rows.join(parts, ["file", "part"])
    rows = carried(rows, "block", ["file", "part"], F.col("ends") > 0, F.col("tail"), F.col("ends"), F.col("ends_0"), F.col("open_0"))
    sizes = F.concat(F.array(F.col("_open") + F.col("head")), F.col("inner"))
    return rows.filter("ends > 0").select("file", "_ends", F.posexplode(sizes).alias("k", "n_tokens")).select("file", (F.col("_ends") + F.col("k")).alias("number"), "n_tokens")


def token_counts(docs: DataFrame, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """(doc_id, n_tokens), a row for each row of docs: its tokens in the flat files, without the end.

    Null text counts as empty and has 0 tokens; null ids and repeated rows stay; ids are longs.
    """
    scratch = Scratch(docs.sparkSession, "tokens")
    files = scratch.keep(written(docs, block_tokens), "files", STEP_BYTES, **stored_by(block_tokens))
    found = stitched(scanned(files.filter("tokens IS NOT NULL")), scratch)
    listed = files.filter("ids IS NOT NULL").select("file", "first", F.posexplode("ids").alias("k", "doc_id"))
    return listed.select("file", (F.col("first") + F.col("k")).alias("number"), "doc_id").join(found, ["file", "number"]).select("doc_id", "n_tokens")


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"))


OP4_SQL = "SELECT doc_id, CAST(strlen(coalesce(text, '')) AS BIGINT) AS n_tokens FROM documents"
