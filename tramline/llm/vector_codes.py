"""Vector codes: each part of a vector becomes the index of its nearest codebook entry, in whole numbers throughout.

Vectors are kept as columnar blocks: one row for each block, its numbers dimension by dimension. A round of training is
a treeAggregate over the blocks' RDD: in each task distances to all entries accumulate dimension by dimension, np.add.at
adds up sums and counts of the parts that each entry gets, and these tensors, of fixed size, merge in a reduction tree.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tramline.llm.common import Scratch, table

SCALE, PARTS, ENTRIES, ROUNDS = 4096, 8, 16, 6
BLOCK_ROWS = 8192
#: Whole numbers beyond this size could overflow 64 bits, so their blocks are worked on as Python's integers.
SMALL = 1 << 23
LONG = (1 << 63) - 1

#: A codebook for each part: (entries, dimensions of the part).
Codebooks = list[np.ndarray]
#: For each part, sums (entries, dimensions) and counts (entries).
Totals = list[tuple[np.ndarray, np.ndarray]]


def part_bounds(dimension: int, parts: int = PARTS) -> list[tuple[int, int]]:
    """Equal consecutive parts; where the dimension isn't a multiple of them, the first ones are longer by one."""
    sizes = [dimension // parts + (k < dimension % parts) for k in range(parts)]
    return [(sum(sizes[:k]), sum(sizes[: k + 1])) for k in range(parts)]


def whole_numbers(x: np.ndarray, scale: int) -> np.ndarray:
    """floor(scale * x), as 64-bit numbers where small, else as Python's integers."""
    y = np.floor(x * float(scale))
    return y.astype(np.int64) if np.abs(y).max(initial=0) <= SMALL else np.array([int(v) for v in y.ravel()], object).reshape(y.shape)


def assigned(block: np.ndarray, codebook: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest entry of each part (the lowest index of equals) and its squared distance; block: (dimensions, n)."""
    wide = object if object in (block.dtype, codebook.dtype) else np.int64
    distance = np.zeros((len(codebook), block.shape[1]), wide)
    for j in range(block.shape[0]):
        gap = block[j][None] - codebook[:, j][:, None]
        distance += gap * gap
    code = distance.argmin(axis=0)
    return code, distance[code, np.arange(block.shape[1])]


def block_totals(block: np.ndarray, codebooks: Codebooks, bounds: list[tuple[int, int]]) -> Totals:
    out = []
    for (a, b), codebook in zip(bounds, codebooks, strict=True):
        part = block[a:b]
        code, _ = assigned(part, codebook)
        sums, counts = np.zeros(codebook.shape, part.dtype), np.zeros(len(codebook), np.int64)
        np.add.at(sums, code, part.T)
        np.add.at(counts, code, 1)
        out.append((sums, counts))
    return out


def merged(a: Totals | None, b: Totals | None) -> Totals | None:
    if a is None or b is None:
        return b if a is None else a
    return [(s + t, m + n) for (s, m), (t, n) in zip(a, b, strict=True)]


def replaced(codebooks: Codebooks, totals: Totals | None) -> Codebooks:
    """Entries become the floor of their parts' mean; unused ones stay."""
    if totals is None:
        return codebooks
    return [np.where((n > 0)[:, None], s // np.maximum(n, 1)[:, None], c) for c, (s, n) in zip(codebooks, totals, strict=True)]


def opened(row: T.Row) -> np.ndarray:
    """The numbers of a block row, (dimensions, n)."""
    shape = (row["dimensions"], row["n"])
    if row["exact"] is not None:
        return np.array([int(x) for x in row["exact"]], object).reshape(shape)
    return np.frombuffer(row["numbers"], "<i4").astype(np.int64).reshape(shape)


def kept_rows(vectors: DataFrame) -> DataFrame:
    """Rows whose vector is neither null nor holds null or non-finite components."""
    bad = F.exists("embedding", lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    return vectors.select("vec_id", F.col("embedding").cast("array<double>").alias("embedding"), "label").filter(F.coalesce(~bad, F.lit(False)))


def coded(vectors: DataFrame, scale: int = SCALE, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> tuple[DataFrame, Codebooks]:
    """(vec_id, label, code, error) for each kept row, and the final codebooks.

    Null ids are rows like others (last among the smallest ids), and repeated rows are each a row; of equal ids the
    lesser vector counts as the smaller. Rows of another length than the commonest (the shorter of equals) can't share
    the codebooks and go. Fewer rows than entries give as many entries. An error beyond 64 bits is NULL. An empty table
    gives an empty result and no codebooks.
    """
    spark = vectors.sparkSession
    scratch = Scratch(spark, "codes")
    rows = kept_rows(vectors)
    common = rows.groupBy(F.size("embedding").alias("d")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "d").first()
    result = T.StructType([vectors.schema["vec_id"], vectors.schema["label"], T.StructField("code", T.StringType()), T.StructField("error", T.LongType())])
    if common is None:
        return spark.createDataFrame([], result), []
    dimension = common["d"]
    bounds = part_bounds(dimension, parts)
    rows = rows.filter(F.size("embedding") == dimension)

    def pack(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, BLOCK_ROWS):
                batch = whole.slice(at, BLOCK_ROWS)
                x = batch.column("embedding").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, dimension)
                block = whole_numbers(x, scale).T
                small = block.dtype != object
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([batch.num_rows], pa.int32()),
                        pa.array([dimension], pa.int32()),
                        pa.array([np.ascontiguousarray(block, "<i4").tobytes() if small else None], pa.binary()),
                        pa.array([None if small else [str(v) for v in block.ravel()]], pa.list_(pa.string())),
                        pa.array([batch.column("vec_id").to_pylist()], pa.list_(batch.schema.field("vec_id").type)),
                        pa.array([batch.column("label").to_pylist()], pa.list_(batch.schema.field("label").type)),
                    ],
                    names=["n", "dimensions", "numbers", "exact", "vec_id", "label"],
                )

    kind = {c: vectors.schema[c].dataType.simpleString() for c in ("vec_id", "label")}
    packed = rows.mapInArrow(pack, f"n int, dimensions int, numbers binary, exact array<string>, vec_id array<{kind['vec_id']}>, label array<{kind['label']}>")
    blocks = scratch.keep(packed, "blocks")
    first = rows.orderBy(F.asc_nulls_last("vec_id"), "embedding").limit(entries).select("embedding").collect()
    start = whole_numbers(np.array([r[0] for r in first], float).reshape(len(first), dimension), scale)
    codebooks = [start[:, a:b] for a, b in bounds]
    numbers = blocks.select("n", "dimensions", "numbers", "exact").rdd
    for _ in range(rounds):
        held = spark.sparkContext.broadcast(codebooks)  # parts * entries rows of a part each, at any size
        totals = numbers.treeAggregate(None, lambda t, row, held=held: merged(t, block_totals(opened(row), held.value, bounds)), merged)
        codebooks = replaced(codebooks, totals)
    final = spark.sparkContext.broadcast(codebooks)

    def assign(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k, row in enumerate(batch.select(["n", "dimensions", "numbers", "exact"]).to_pylist()):
                block = opened(row)
                found = [assigned(block[a:b], c) for (a, b), c in zip(bounds, final.value, strict=True)]
                text = np.stack([code for code, _ in found], axis=1).astype(np.uint8)
                hexes = text.tobytes().hex()
                error = [int(e) if e <= LONG else None for e in sum(e.astype(object) for _, e in found)]
                width = 2 * len(bounds)
                codes = [hexes[i : i + width] for i in range(0, len(hexes), width)]
                lists = [batch.column(c).slice(k, 1).flatten() for c in ("vec_id", "label")]
                yield pa.RecordBatch.from_arrays([*lists, pa.array(codes, pa.string()), pa.array(error, pa.int64())], names=["vec_id", "label", "code", "error"])

    return blocks.mapInArrow(assign, result), codebooks


def codebook_digest(codebooks: Codebooks) -> str:
    """SHA-256 (hex) of all components in decimals, by part, entry and position, joined by commas."""
    return hashlib.sha256(",".join(str(v) for c in codebooks for v in c.ravel()).encode()).hexdigest()


def with_label_error(codes: DataFrame) -> DataFrame:
    """label_error: the errors summed over rows of the same label, those without one together; NULL beyond 64 bits.

    Sums are combined before the shuffle; the labels' table is joined, not broadcast, unless Spark finds it small.
    """
    by = codes.groupBy(F.col("label").alias("_label")).agg(F.try_sum("error").alias("label_error"))
    return codes.join(by, codes["label"].eqNullSafe(by["_label"]), "left").drop("_label")


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Codes of all kept rows of `embeddings`; see coded and with_label_error."""
    codes, codebooks = coded(table(spark, sf_dir, "embeddings"))
    codes = Scratch(spark, "coded").keep(codes, "codes")
    return with_label_error(codes).select("vec_id", "code", "error", "label_error", F.lit(codebook_digest(codebooks)).alias("codebooks_sha256"))


def oracle(parts: int = PARTS, width: int = 8, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> str:
    """The same in DuckDB, for vectors of parts * width components."""
    steps = [
        f"""kept AS (SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor({scale} * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)""",
        f"pieces AS MATERIALIZED (SELECT vec_id, label, p, v[p * {width} + 1 : p * {width} + {width}] AS x FROM kept, range({parts}) AS r(p))",
        f"c0 AS MATERIALIZED (SELECT p, e, x AS c FROM pieces JOIN (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS e FROM kept QUALIFY e < {entries}) USING (vec_id))",
    ]
    distance = "list_sum(list_transform(list_zip(x, c), lambda y: (y[1] - y[2]) * (y[1] - y[2])))"
    for k in range(rounds + 1):
        steps.append(f"a{k} AS MATERIALIZED (SELECT vec_id, label, p, x, min_by(e, d * {entries} + e) AS e, min(d) AS d FROM (SELECT vec_id, label, p, x, e, CAST({distance} AS BIGINT) AS d FROM pieces JOIN c{k} USING (p)) GROUP BY ALL)")
        if k < rounds:
            steps.append(f"m{k} AS (SELECT p, e, list(m ORDER BY i) AS m FROM (SELECT p, e, i, CAST((s - ((s % n) + n) % n) // n AS BIGINT) AS m FROM (SELECT p, e, i, sum(x[i]) AS s, count(*) AS n FROM a{k}, range(1, {width} + 1) AS r(i) GROUP BY ALL)) GROUP BY p, e)")
            steps.append(f"c{k + 1} AS MATERIALIZED (SELECT p, e, coalesce(m, c) AS c FROM c{k} LEFT JOIN m{k} USING (p, e))")
    last = f"a{rounds}"
    return f"""WITH {", ".join(steps)},
coded AS (SELECT vec_id, label, string_agg(printf('%02x', e), '' ORDER BY p) AS code, CAST(sum(d) AS BIGINT) AS error FROM {last} GROUP BY vec_id, label)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
  (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY p, e)) FROM c{rounds}) AS codebooks_sha256 FROM coded"""


OP13_SQL = oracle()
