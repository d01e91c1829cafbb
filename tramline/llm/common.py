"""What the training-data operators share: reading tables, cutting lineage, and batches of texts as flat arrays."""

from __future__ import annotations

import ctypes
import re
import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of text that one numpy step works on; a longer text is a step of its own.
CHUNK_BYTES = 2 << 20
#: The ASCII white space of the contracts, which is also what bytes.split() splits at.
SPACES = (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D)

IS_SPACE = np.zeros(256, bool)
IS_SPACE[list(SPACES)] = True
#: A-Z to a-z, other bytes unchanged.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32
LOWER_BYTES = LOWER.tobytes()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def doc_texts(docs: DataFrame) -> DataFrame:
    """doc_id and text, null text read as empty; other columns go."""
    return docs.select("doc_id", F.coalesce(F.col("text"), F.lit("")).alias("text"))


def keyed_texts(docs: DataFrame, rest: bool = False) -> DataFrame:
    """doc_texts with th: with doc_id it names a row's text, also where ids repeat or are null with other texts.

    th is half of the text's SHA-256, so no two texts of a corpus share it. rest: the other columns come along in the
    struct `row`, where their names clash with nothing.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select("doc_id", F.unhex(F.substring(F.sha2(F.encode(text, "UTF-8"), 256), 1, 32)).alias("th"), text.alias("text"), *[F.struct(*others(docs)).alias("row")] * rest)


def others(docs: DataFrame) -> list[Column]:
    """All columns but the text, and under that name whether it is null."""
    return [docs[c].isNull().alias("text") if c.lower() == "text" else docs[c] for c in docs.columns]


def unpacked(df: DataFrame, docs: DataFrame, text: str = "text") -> DataFrame:
    """The columns of docs again, with the text in column `text` of df; null where it was null."""
    return df.select(*[F.when(~F.col("row")["text"], F.col(text)).alias(c) if c.lower() == "text" else F.col("row")[c].alias(c) for c in docs.columns])


def id_crc32(doc_id: Column) -> Column:
    """CRC-32 of the id as decimal text; a null id counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary"))


def same_doc(left: DataFrame, right: DataFrame, how: str) -> DataFrame:
    """Joins on (doc_id, th), null ids alike; the right side's keys go."""
    renamed = right.withColumnsRenamed({"doc_id": "_doc_id", "th": "_th"})
    on = left["doc_id"].eqNullSafe(renamed["_doc_id"]) & (left["th"] == renamed["_th"])
    return left.join(renamed, on, how).drop("_doc_id", "_th")


@cache
def own_folder() -> str:
    """For sessions without spark.checkpoint.dir: those on one machine, as in tests."""
    return f"file://{tempfile.mkdtemp(prefix='tramline-')}"


class Scratch:
    """Intermediate tables in the folder that all executors share (spark.checkpoint.dir).

    A table that is kept there cuts lineage: a lost executor repeats only what follows it. Results are lazy and read
    these tables, so what drop() hasn't deleted goes when the driver ends. Where the setting is missing, a session on
    one machine, as in tests, gets a new local folder; on a cluster that is an error.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        root = spark.conf.get("spark.checkpoint.dir", None)
        if not root and not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        self.root = f"{(root or own_folder()).rstrip('/')}/{name}-{uuid.uuid4().hex}"
        path = spark._jvm.org.apache.hadoop.fs.Path(self.root)
        files = path.getFileSystem(spark._jsc.hadoopConfiguration())
        files.mkdirs(path)
        files.deleteOnExit(path)

    def keep(self, df: DataFrame, name: str, batch_bytes: int | None = None, **options: str) -> DataFrame:
        """batch_bytes: about as much goes to a Python worker at once, a row at least; otherwise what the session says."""
        path = f"{self.root}/{name}"
        conf, settings = self.spark.conf, {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}  # the shuffle files of this write are of no more use
        if batch_bytes is not None:
            settings["spark.sql.execution.arrow.maxBytesPerBatch"] = f"{batch_bytes}b"
        before = {key: conf.get(key, None) for key in settings}
        try:
            for key, value in settings.items():
                conf.set(key, value)
            df.write.options(**{"compression": "zstd", **options}).parquet(path)
        finally:
            for key, value in before.items():
                conf.unset(key) if value is None else conf.set(key, value)
        return self.spark.read.parquet(path)

    def drop(self, name: str) -> None:
        """Deletes a table that nothing reads any more."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


#: See within_task.
_kept: list[dict] = []


def within_task() -> dict:
    """A dict of values that a worker makes once a task; empty again when the task's `tidy` work ends."""
    out: dict = {}
    _kept.append(out)
    return out


def tidy(work: Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The same work, after which the worker gives free memory back: executors keep idle workers, beside those of the next step."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from work(batches)
        finally:
            for held in _kept:
                held.clear()
            pa.default_memory_pool().release_unused()
            if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):  # glibc keeps freed numpy arrays otherwise
                trim(0)

    return run


def cut(batches: Iterable[pa.RecordBatch], column: str = "text", most: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of the batches with about `most` bytes of text, a row at least; none without rows."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        sizes = np.cumsum(pc.binary_length(batch.column(column)).fill_null(0).to_numpy(zero_copy_only=False))
        at = 0
        while at < batch.num_rows:
            before = sizes[at - 1] if at else 0
            end = max(at + 1, int(np.searchsorted(sizes, before + most, side="right")))
            yield batch.slice(at, end - at)
            at = end


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All values' bytes as one uint8 array, and n + 1 offsets. The column has no nulls."""
    kind = np.int64 if pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type) else np.int32
    buffers = column.buffers()
    offsets = np.frombuffer(buffers[1], kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(buffers[2], np.uint8) if buffers[2] is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def lists(values: np.ndarray, counts: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    """A list column of counts[i] values each."""
    offsets = np.concatenate(([0], np.cumsum(counts))).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, kind))


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of uint64 that spreads every bit (the finaliser of SplitMix64; fixed constants)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_bounds(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words (runs without white space) of each text, and n + 1 offsets into them."""
    inside = np.zeros(len(data) + 2, bool)
    np.logical_not(IS_SPACE[data], out=inside[1:-1])
    change = inside[1:] != inside[:-1]
    edges = offsets[1:-1]
    edges = edges[(edges > 0) & (edges < len(data))]
    edges = np.unique(edges[inside[edges] & inside[edges + 1]])  # a text that ends in a word before one that begins with one
    starts = np.flatnonzero(change & inside[1:])
    ends = np.flatnonzero(change & ~inside[1:])
    if len(edges):
        starts = np.sort(np.concatenate((starts, edges)))
        ends = np.sort(np.concatenate((ends, edges)))
    return starts, ends, np.searchsorted(starts, offsets)
