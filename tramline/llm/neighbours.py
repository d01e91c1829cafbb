"""Approximate nearest neighbours by multiprobe p-stable hashing.

Inner products become Euclidean distances by one more dimension. Each table hashes a vector by K Gaussian projections,
cut into bins of a fixed width. A query visits a table's buckets in the order of its squared distance to their bins,
which is the order of estimated success, until they hold a set fraction of all rows. Candidates of all tables are
merged, and ranked by exact inner products.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tramline.llm.common import Scratch, table
from tramline.llm.shards import grid

TABLES, PROJECTIONS, WIDTH, BINS = 2, 4, 1.5, 6
#: Of all rows, how many each table's visited buckets hold. Vectors far apart in every direction need such a large part.
FRACTION = 0.65
SHARD_ROWS, SHARD_QUERIES = 20_000, 2_000
NEAREST = 20


class Hashes(NamedTuple):
    """Projections (table, dimension + 1, K), offsets (table, K) and the largest norm."""

    lines: np.ndarray
    offsets: np.ndarray
    norm: float

    def places(self, x: np.ndarray, query: bool) -> np.ndarray:
        """(table, n, K): projections in bin widths, counted from the lowest bin's lower end."""
        size = np.linalg.norm(x, axis=1)
        if query:
            wide = np.concatenate((x * (self.norm / size)[:, None], np.zeros((len(x), 1))), axis=1)
        else:
            wide = np.concatenate((x, np.sqrt(np.maximum(self.norm**2 - size**2, 0))[:, None]), axis=1)
        return np.matmul(wide[None], self.lines) / (WIDTH * self.norm) + self.offsets[:, None] + BINS // 2

    def buckets(self, x: np.ndarray) -> np.ndarray:
        """(table, n) bucket numbers; the outer bins are open."""
        bins = np.clip(np.floor(self.places(x, query=False)), 0, BINS - 1).astype(np.int64)
        return bins @ BINS ** np.arange(PROJECTIONS)


def hashes(dimension: int, norm: float, seed: int = 0) -> Hashes:
    rng = np.random.default_rng(seed)
    return Hashes(rng.normal(size=(TABLES, dimension + 1, PROJECTIONS)), rng.uniform(0, 1, (TABLES, PROJECTIONS)), norm)


def visited(h: Hashes, x: np.ndarray, sizes: np.ndarray, fraction: float) -> list[np.ndarray]:
    """For each table, an (n, buckets) mask of those that each query visits; sizes: (table, buckets) rows."""
    every = np.arange(BINS**PROJECTIONS)[:, None] // BINS ** np.arange(PROJECTIONS) % BINS
    out = []
    for places, size in zip(h.places(x, query=True), sizes, strict=True):
        held = np.flatnonzero(size)
        low, high = every[held].astype(float), every[held] + 1.0
        low[every[held] == 0], high[every[held] == BINS - 1] = -np.inf, np.inf
        gap = sum(np.maximum(0, np.maximum(low[:, k] - places[:, k, None], places[:, k, None] - high[:, k])) ** 2 for k in range(PROJECTIONS))
        order = np.argsort(gap, axis=1, kind="stable")
        before = np.cumsum(size[held][order], axis=1) - size[held][order]
        mask = np.zeros((len(x), len(size)), bool)
        np.put_along_axis(mask, held[order], before < fraction * size.sum(), axis=1)
        out.append(mask)
    return out


def best(q_rows: np.ndarray, q: np.ndarray, rows: np.ndarray, ids: np.ndarray, x: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each query's k largest inner products (places of query and candidate, score), never with its own row; ties to smaller ids, then rows.

    The fast product only finds those that may belong there; each score is a plain sum of its own products.
    """
    rough = q @ x.T
    rough[q_rows[:, None] == rows[None]] = -np.inf
    least = np.partition(rough, -k, axis=1)[:, -k] if len(rows) > k else np.full(len(q), -np.inf)
    slack = 1e-9 * (1 + np.abs(np.where(np.isfinite(least), least, 0)))
    a, b = np.nonzero((rough >= (least - slack)[:, None]) & (rough > -np.inf))
    score = np.concatenate([(q[a[i : i + 65536]] * x[b[i : i + 65536]]).sum(axis=1) for i in range(0, len(a), 65536)] or [np.zeros(0)])
    order = np.lexsort((rows[b], ids[b], -score, a))
    a, b, score = a[order], b[order], score[order]
    rank = np.arange(len(a)) - np.searchsorted(a, a)
    return a[rank < k], b[rank < k], score[rank < k]


def matrix(column: pa.ChunkedArray | pa.Array, dimension: int) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dimension)


def usable(vectors: DataFrame) -> DataFrame:
    """vec_id and embedding of the rows that take part: no null, empty or zero vector, no null or non-finite component."""
    bad = F.exists("embedding", lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    return vectors.select("vec_id", "embedding").filter(~bad & F.exists("embedding", lambda v: v != 0))


def nearest(vectors: DataFrame, queries: str = "vec_id % 20 = 0", k: int = NEAREST, fraction: float = FRACTION, seed: int = 0) -> DataFrame:
    """(query_id, rank, vec_id, score): the k largest inner products found for each query row.

    Rows that don't take part (see usable) and those of another length than the commonest are no query and no
    candidate. Each row is its own candidate, and query if its id is one, also where ids repeat; a null id is no query,
    and last among equal scores. Fewer candidates than k give fewer rows. Without rows the result is empty.
    """
    spark, scratch = vectors.sparkSession, Scratch(vectors.sparkSession, "neighbours")
    # numbers that no two rows share; they stay as they are, since the table is written
    rows = scratch.keep(usable(vectors).withColumn("row", F.monotonically_increasing_id()), "rows")
    found = rows.groupBy(F.size("embedding").alias("d")).agg(F.count("*").alias("n"), F.max(F.aggregate("embedding", F.lit(0.0), lambda s, v: s + v.cast("double") * v)).alias("norm")).orderBy(F.desc("n"), "d").first()
    result = "q_row long, query_id long, row long, vec_id long, score double"
    if found is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    dimension, norm = found["d"], float(np.sqrt(found["norm"]))
    rows = rows.filter(F.size("embedding") == dimension)
    held = spark.sparkContext.broadcast(hashes(dimension, norm, seed))

    def place(batches):
        for batch in batches:
            if batch.num_rows:
                buckets = held.value.buckets(matrix(batch.column("embedding"), dimension))
                for t in range(TABLES):
                    yield pa.RecordBatch.from_arrays([pa.array(t * BINS**PROJECTIONS + buckets[t], pa.int32()), *batch.select(names).columns], names=["bucket", *names])

    names = ["vec_id", "embedding", "row"]
    kinds = f"vec_id long, embedding {rows.schema['embedding'].dataType.simpleString()}, row long"
    index = scratch.keep(rows.mapInArrow(place, f"bucket int, {kinds}"), "index")
    # at most TABLES * BINS ** PROJECTIONS numbers, at any size
    sizes = np.zeros(TABLES * BINS**PROJECTIONS)
    for r in index.groupBy("bucket").count().collect():
        sizes[r["bucket"]] = r["count"]
    shards = max(1, min(int(np.count_nonzero(sizes)), int(-(-sizes.sum() // SHARD_ROWS))))
    counts = spark.sparkContext.broadcast(sizes.reshape(TABLES, -1))

    def probe(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            masks = np.concatenate(visited(held.value, matrix(batch.column("embedding"), dimension), counts.value, fraction), axis=1)
            of = np.arange(masks.shape[1]) % shards
            for s in range(shards):
                own = np.flatnonzero(of == s)
                some = np.flatnonzero(masks[:, own].any(axis=1))
                lists = [own[masks[i, own]].tolist() for i in some]
                part = batch.select(names).take(pa.array(some))
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(some), s, np.int32)), *part.columns, pa.array(lists, pa.list_(pa.int32()))], names=["shard", *names, "buckets"])

    probes = rows.filter(queries).mapInArrow(probe, f"shard int, {kinds}, buckets array<int>")
    left, right = grid(scratch, index.withColumn("shard", F.col("bucket") % shards), scratch.keep(probes, "probes"), ["shard"], SHARD_ROWS, SHARD_QUERIES, ("row", "row"))

    def search(candidates: pa.Table, asked: pa.Table) -> pa.Table:
        own, x, bucket = candidates.column("row").to_numpy(), matrix(candidates.column("embedding"), dimension), candidates.column("bucket").to_numpy()
        ids = pc.fill_null(candidates.column("vec_id"), np.iinfo(np.int64).max).to_numpy()
        q_own, q = asked.column("row").to_numpy(), matrix(asked.column("embedding"), dimension)
        lists = asked.column("buckets").combine_chunks()
        to, of = np.repeat(np.arange(len(q_own)), lists.value_lengths().to_numpy()), lists.flatten().to_numpy()
        parts = []
        for bin_ in np.unique(bucket) if len(q_own) else ():
            at, some = np.flatnonzero(bucket == bin_), to[of == bin_]
            for k0 in range(0, len(some), 512):
                few = some[k0 : k0 + 512]
                a, b, score = best(q_own[few], q[few], own[at], ids[at], x[at], k)
                parts.append((few[a], at[b], score))
        a, b, score = (np.concatenate(c) for c in zip(*parts, strict=True)) if parts else (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))
        order = np.lexsort((own[b], ids[b], -score, a))
        a, b, score = a[order], b[order], score[order]
        new = np.ones(len(a), bool)  # a candidate of both tables comes twice in a row
        new[1:] = (a[1:] != a[:-1]) | (own[b[1:]] != own[b[:-1]])
        a, b, score = a[new], b[new], score[new]
        first = np.arange(len(a)) - np.searchsorted(a, a) < k
        a, b = a[first], b[first]
        return pa.table({"q_row": q_own[a], "query_id": asked.column("vec_id").take(pa.array(a)), "row": own[b], "vec_id": candidates.column("vec_id").take(pa.array(b)), "score": score[first]})

    cell = ["shard", "gl", "gr"]
    hits = left.groupBy(*cell).cogroup(right.groupBy(*cell)).applyInArrow(search, result).distinct()
    order = Window.partitionBy("q_row").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"), "row")
    return hits.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op7_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(table(spark, sf_dir, "embeddings"))
