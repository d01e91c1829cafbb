"""SimHash near-dedup by a segment-popcount embedding.

A 64-bit fingerprint becomes the vector of the numbers of set bits in its 32 two-bit segments. The Manhattan distance of
two vectors is at most the Hamming distance of their fingerprints, so pairs beyond it need no exact look. A grid over
the embedding finds the candidates: the dimensions form some subspaces; vectors within distance d differ in at most d
of them, so they share a cell in at least one choice of all but d subspaces. The more fingerprints, the more subspaces
and the finer the cells.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import combinations, pairwise
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tramline.llm.common import LOWER_BYTES, Scratch, cut, doc_texts, keyed_texts, same_doc, table, tidy, unpacked

SHINGLE = 3
SEED = 42
DISTANCE = 2
SEGMENT_BITS = 2
#: Numbers of subspaces, one of which is taken by the number of fingerprints.
PARTS = (4, 5, 6, 8, 11)
#: Chance that two unrelated fingerprints have as many bits in one segment.
SEGMENT_ALIKE = sum(comb(SEGMENT_BITS, k) ** 2 for k in range(SEGMENT_BITS + 1)) / 4**SEGMENT_BITS
#: Cells that hold more fingerprints, all near each other, aren't paired; they link through one-bit neighbours instead, as exactly.
PAIRED_MOST = 32


def fingerprint(words: list[bytes], shingle: int = SHINGLE) -> int:
    """SimHash of a word list; 0 without words."""
    if not words:
        return 0
    if len(words) <= shingle:
        parts = [b" ".join(words)]
    else:
        joined = b" ".join(words)
        ends = np.cumsum([len(w) + 1 for w in words])
        starts = np.concatenate(([0], ends[:-shingle])).tolist()
        parts = [joined[a:b] for a, b in zip(starts, (ends[shingle - 1 :] - 1).tolist(), strict=True)]
    hashes = np.array([xxhash.xxh64_intdigest(p, SEED) for p in parts], ">u8")
    counts = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        counts += np.unpackbits(hashes[at : at + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * counts > len(hashes)).tobytes(), "big")


def fingerprints(docs: DataFrame, columns: list[str], shingle: int = SHINGLE) -> DataFrame:
    """`columns` of docs, and the fingerprint of its text (without nulls) as a long `fp`."""

    @tidy
    def find(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in cut(batches):
            fps = [fingerprint(x.as_buffer().to_pybytes().translate(LOWER_BYTES).split(), shingle) for x in batch.column("text")]
            out = batch.select(columns)
            yield pa.RecordBatch.from_arrays([*out.columns, pa.array(np.array(fps, np.uint64).view(np.int64))], names=[*columns, "fp"])

    schema = ", ".join(f"{c} {docs.schema[c].dataType.simpleString()}" for c in columns)
    return docs.select(*{c: 0 for c in [*columns, "text"]}).mapInArrow(find, f"{schema}, fp long")


def embedded(fp: Column) -> Column:
    """The vector of segment popcounts, as an array of tinyints."""
    mask = (1 << SEGMENT_BITS) - 1
    return F.array(*[F.bit_count(F.shiftrightunsigned(fp, k).bitwiseAND(F.lit(mask))).cast("byte") for k in range(0, 64, SEGMENT_BITS)])


def subspaces(n: int, distance: int) -> int:
    """The least of PARTS for which a cell holds one of n unrelated fingerprints, or fewer, beside one's own."""
    for parts in PARTS:
        if n * SEGMENT_ALIKE ** (64 // SEGMENT_BITS * (parts - distance) // parts) <= 1:
            break
    return parts


def cells(vector: Column, distance: int, parts: int) -> Column:
    """The grid cells of a vector: for each choice of all but `distance` subspaces, the choice's number and a hash of the counts."""
    edge = [64 // SEGMENT_BITS * k // parts for k in range(parts + 1)]
    part = [F.slice(vector, 1 + a, b - a) for a, b in pairwise(edge)]
    return F.array(*[F.struct(F.lit(n).alias("choice"), F.xxhash64(*[part[k] for k in kept]).alias("hash")) for n, kept in enumerate(combinations(range(parts), parts - distance))])


def manhattan(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: F.abs(x.cast("int") - y)), F.lit(0), lambda s, x: s + x)


def hamming(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b))


def links(fps: DataFrame, scratch: Scratch, distance: int = DISTANCE, parts: int | None = None) -> DataFrame:
    """Edges (a, b) whose components are those of all pairs of distinct fingerprints within the distance.

    Crowded cells emit no pairs: each fingerprint there is linked with the least one of those that share a neighbour
    at distance 1 with it, which joins all that are within 2, exactly and with 65 rows for each fingerprint.
    """
    if distance != 2:
        raise ValueError("crowded cells are linked exactly at distance 2 only")
    grid = fps.select("fp", embedded(F.col("fp")).alias("v")).select("fp", "v", F.explode(cells(F.col("v"), distance, parts or subspaces(fps.count(), distance))).alias("cell"))
    grid = scratch.keep(grid.select("fp", "v", "cell.choice", "cell.hash"), "grid")
    sizes = scratch.keep(grid.groupBy("choice", "hash").count().filter("count > 1"), "sizes")
    few = sizes.filter(f"count <= {PAIRED_MOST}").select("choice", "hash")
    paired = grid.join(few, ["choice", "hash"], "left_semi")
    a, b = paired.alias("a"), paired.alias("b")
    near = (manhattan(F.col("a.v"), F.col("b.v")) <= distance) & (hamming(F.col("a.fp"), F.col("b.fp")) <= distance)
    same = (F.col("a.choice") == F.col("b.choice")) & (F.col("a.hash") == F.col("b.hash")) & (F.col("a.fp") < F.col("b.fp"))
    pairs = a.join(b, same & near).select(F.col("a.fp").alias("a"), F.col("b.fp").alias("b"))

    crowded = grid.join(sizes.filter(f"count > {PAIRED_MOST}").select("choice", "hash"), ["choice", "hash"], "left_semi").select("fp").distinct()
    flips = [F.col("fp"), *[F.col("fp").bitwiseXOR(F.lit(1 << k if k < 63 else -(1 << 63))) for k in range(64)]]
    near_by = scratch.keep(crowded, "crowded").select("fp", F.explode(F.array(*flips)).alias("via"))
    hubs = near_by.groupBy("via").agg(F.min("fp").alias("b"), F.count("*").alias("n")).filter("n > 1").select("via", "b")
    hubs = scratch.keep(hubs, "hubs")
    through = near_by.join(hubs, "via").filter("fp <> b").select(F.col("fp").alias("a"), "b")
    return scratch.keep(pairs.union(through).distinct(), "links")


def components(edges: DataFrame, scratch: Scratch, name: str = "components") -> DataFrame:
    """(node, root) of every node of the edges (a, b); root is the least node of its component.

    Alternates large-star and small-star steps, so the rounds are about the logarithm of a component's length; each
    round's edges are a kept table, and only their number and a checksum come to the driver.
    """
    edges = edges.selectExpr("greatest(a, b) AS a", "least(a, b) AS b").filter("a <> b").distinct()
    edges, before, turn = scratch.keep(edges, f"{name}-0"), None, 0
    while True:
        both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).union(edges.select("b", "a"))
        least = scratch.keep(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), f"{name}-least-{turn}")
        large = both.filter("v > u").join(least, "u").selectExpr("v AS a", "m AS b").distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a")
        small = small.selectExpr("a", "m AS b").union(small.selectExpr("b AS a", "m AS b")).filter("a <> b").distinct()
        turn += 1
        edges = scratch.keep(small, f"{name}-{turn}")
        now = tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first())
        if turn > 1:
            scratch.drop(f"{name}-{turn - 2}")
        if now == before:
            break
        before = now
    roots = edges.select(F.col("b").alias("node")).distinct()
    return edges.selectExpr("a AS node", "b AS root").union(roots.selectExpr("node", "node AS root"))


def labelled(docs: DataFrame, columns: list[str], scratch: Scratch, order: str, shingle: int = SHINGLE, distance: int = DISTANCE) -> DataFrame:
    """`columns` of docs with fp and `first`: the least `order` value of all rows of the component."""
    rows = scratch.keep(fingerprints(docs, columns, shingle), "fingerprints")
    fps = rows.groupBy("fp").agg(F.min(order).alias("least"))
    found = scratch.keep(components(links(fps, scratch, distance), scratch), "found")
    # a component's name is the least order value of its fingerprints, found before rows are touched
    named = fps.join(found.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    least = named.groupBy("root").agg(F.min("least").alias("first"))
    named = scratch.keep(named.join(least, "root").select("fp", "first"), "named")
    return rows.join(named, "fp")


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, distance: int = DISTANCE) -> DataFrame:
    """(doc_id, fingerprint, component_id), a row for each row of docs.

    Null text counts as empty; texts without words have fingerprint 0 and link like others. A null doc_id is never the
    name of a component unless all ids of it are null. Repeated rows stay.
    """
    scratch = Scratch(docs.sparkSession, "simhash")
    out = labelled(doc_texts(docs), ["doc_id"], scratch, "doc_id", shingle, distance)
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), F.col("first").alias("component_id"))


def keep_one(docs: DataFrame, shingle: int = SHINGLE, distance: int = DISTANCE) -> DataFrame:
    """docs with one row of each component: that with the least doc_id (nulls last; of repeated ids the least text key)."""
    rows = keyed_texts(docs, rest=True).withColumn("place", F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"), F.col("th").alias("th")))
    scratch = Scratch(docs.sparkSession, "simhash")
    kept = labelled(rows, ["place"], scratch, "place", shingle, distance).filter("place = first").select("place").distinct()
    kept = kept.select(F.col("place.id").alias("doc_id"), F.col("place.th").alias("th"))
    out = same_doc(rows.drop("place"), kept, "left_semi")
    return unpacked(out.dropDuplicates(["doc_id", "th"]), docs)


def op3_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))
