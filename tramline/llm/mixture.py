"""Mixing sources to target weights, in DataFrame functions only.

Source shares of the tokens are raised to an exponent and normalised. The exponent is bisected until the mixture's
entropy, or its most repeated source, meets the target. Each source's quota of tokens is then filled with whole
permutations of its documents (epochs), and the last one in part: documents fall into blocks by hash, blocks follow in
hashed order, and so do the documents of a block. Offsets are running sums over blocks first and then within a block,
so no window holds a large source. Tokens are UTF-8 bytes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tramline.llm.common import Scratch, keyed_texts, table, unpacked

REPEAT_MOST = 2.0
BLOCK_DOCS = 1024
#: Exponents tried in one step of the search, and steps: an interval shrinks to 1 / 16 each time.
SECTIONS, ROUNDS = 16, 6


def shares(rows: DataFrame) -> DataFrame:
    """(source, docs, tokens, p) for rows with source and tokens; p is NULL for sources without tokens."""
    by = rows.groupBy("source").agg(F.count("*").alias("docs"), F.sum("tokens").alias("tokens"))
    total = by.agg(F.sum("tokens")).first()[0] or 0
    return by.withColumn("p", F.when(F.col("tokens") > 0, F.col("tokens") / F.lit(max(total, 1))))


def measures(by: DataFrame, exponents: list[float]) -> dict[float, tuple[float, float]]:
    """For each exponent, the mixture's entropy in nats, and how often the most repeated source is used for each use of the least."""
    ps = by.filter("p IS NOT NULL").select("p", F.explode(F.array(*map(F.lit, exponents))).alias("a"))
    z, zl = F.sum(F.pow("p", "a")), F.sum(F.pow("p", "a") * F.log("p"))
    ratio = F.pow(F.max("p") / F.min("p"), 1 - F.col("a"))
    return {a: (h, r) for a, h, r in ps.groupBy("a").agg(F.log(z) - F.col("a") * zl / z, ratio).collect()}


def exponent(by: DataFrame, entropy: float | None = None, repeat_most: float | None = None) -> float:
    """The exponent in [0, 1] nearest 0 whose repetition is within repeat_most, or nearest 1 whose entropy reaches the target.

    1 (natural shares) if that meets the entropy target already; 0 if nothing in the range reaches it. Repetition falls
    and entropy falls as the exponent rises, so a bracket holds one turning point. Without sources: 1.
    """
    if (entropy is None) == (repeat_most is None):
        raise ValueError("give either an entropy or a repetition limit")

    def met(h: float, r: float) -> bool:
        return r <= repeat_most * (1 + 1e-12) if entropy is None else h < entropy

    lo, hi = 0.0, 1.0  # not met at lo, met at hi
    ends = measures(by, [lo, hi])
    if not ends:
        return 1.0
    if met(*ends[lo]):
        return lo
    if not met(*ends[hi]):
        return hi
    for _ in range(ROUNDS):
        tried = [lo + (hi - lo) * k / SECTIONS for k in range(1, SECTIONS)]
        found = measures(by, tried)
        yes = [a for a in tried if met(*found[a])]
        no = [a for a in tried if not met(*found[a])]
        lo, hi = max([lo, *no]), min([hi, *yes])
    return hi if entropy is None else lo


def quotas(by: DataFrame, a: float, budget: int | None = None) -> DataFrame:
    """(source, docs, tokens, weight, quota, epochs, part): whole epochs, and the tokens of one more in part.

    Without a budget the tokens suffice to use each source once at least. A source without tokens is used once.
    """
    z, scale = by.agg(F.sum(F.pow("p", F.lit(a))), F.max(F.pow("p", F.lit(1 - a)))).first()
    z, scale = z or 1.0, scale or 1.0
    total = by.agg(F.sum("tokens")).first()[0] or 0
    aim = float(budget) if budget is not None else scale * z * total
    out = by.withColumn("weight", F.coalesce(F.pow("p", F.lit(a)) / z, F.lit(0.0))).withColumn("quota", F.round(F.col("weight") * aim).cast("long"))
    empty = F.col("tokens") == 0
    return out.withColumn("epochs", F.when(empty, 1).otherwise(F.expr("quota div greatest(tokens, 1)")).cast("int")).withColumn("part", F.when(empty, F.lit(0)).otherwise(F.expr("quota % greatest(tokens, 1)")))


def null_safe(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    renamed = right.withColumnsRenamed({k: f"_{k}" for k in keys})
    on = [left[k].eqNullSafe(renamed[f"_{k}"]) for k in keys]
    return left.join(renamed, on, "inner").drop(*[f"_{k}" for k in keys])


def hashed(*columns: Column | str, seed: int) -> Column:
    return F.xxhash64(F.lit(seed), *columns)


def permuted(rows: DataFrame, plan: DataFrame, scratch: Scratch, seed: int = 0) -> DataFrame:
    """rows (id columns, source, tokens) once for each use: with epoch, block, and `start`, the tokens of its epoch before it.

    The last epoch stops at the row that would pass the quota.
    """
    ids = [c for c in rows.columns if c not in ("source", "tokens")]
    wanted = plan.select("source", "docs", "epochs", "part")
    uses = null_safe(rows, wanted, ["source"])
    uses = uses.withColumn("epoch", F.explode(F.expr("sequence(0, epochs - IF(part > 0, 0, 1))"))).filter("epoch <= epochs")
    uses = uses.filter("epochs > 0 OR part > 0")
    blocks = F.ceil(F.col("docs") / BLOCK_DOCS)
    uses = uses.withColumn("block", F.pmod(hashed(*ids, "epoch", seed=seed), blocks)).withColumn("turn", hashed("block", "epoch", seed=seed + 1))
    uses = scratch.keep(uses.withColumn("rank", hashed(*ids, "epoch", seed=seed + 2)), "uses")
    key = ["source", "epoch", "block"]
    sums = uses.groupBy(*key, "turn").agg(F.sum("tokens").alias("size"))
    w = Window.partitionBy("source", "epoch").orderBy("turn", "block").rowsBetween(Window.unboundedPreceding, -1)
    sums = scratch.keep(sums.withColumn("base", F.coalesce(F.sum("size").over(w), F.lit(0))).select(*key, "base"), "sums")
    w = Window.partitionBy(*key).orderBy("rank", *ids).rowsBetween(Window.unboundedPreceding, -1)
    out = null_safe(uses, sums, key).withColumn("start", F.col("base") + F.coalesce(F.sum("tokens").over(w), F.lit(0)))
    return out.filter("epoch < epochs OR start + tokens <= part").select(*ids, "source", "tokens", "epoch", "block", "start")


def mixture(docs: DataFrame, ids: list[str], entropy: float | None = None, repeat_most: float | None = REPEAT_MOST, budget: int | None = None, seed: int = 0) -> DataFrame:
    """The uses of each row of docs (see permuted).

    Null text has no tokens; a null source is a source; null ids are ids like others. Repeated rows are each used, in
    no set order among themselves. An empty table gives an empty mixture.
    """
    scratch = Scratch(docs.sparkSession, "mixture")
    rows = docs.select(*ids, "source", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("tokens"))
    by = scratch.keep(shares(rows), "shares")
    a = exponent(by, entropy, None if entropy is not None else repeat_most)
    return permuted(rows, scratch.keep(quotas(by, a, budget), "quotas"), scratch, seed)


def mixed_texts(docs: DataFrame, **options) -> DataFrame:
    """docs with each row as often as the mixture uses it.

    A row is named by a digest of all its columns, so rows that differ in any, as in their source, are used each by
    itself. Rows alike in all columns are one row with all their uses.
    """
    keyed = keyed_texts(docs, rest=True)
    rest = F.to_json("row", {"ignoreNullFields": "false"})
    keyed = keyed.select(F.unhex(F.substring(F.sha2(F.concat(F.hex("th"), rest), 256), 1, 32)).alias("rh"), "text", "row")
    uses = mixture(keyed.withColumn("source", F.col("row.source")), ["rh"], **options)
    copies = uses.groupBy("rh").agg(F.count("*").cast("int").alias("copies"))
    out = keyed.dropDuplicates(["rh"]).join(copies, "rh")
    return unpacked(out.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies")))), docs)


def op6_temperature_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixture(table(spark, sf_dir, "documents"), ["doc_id"])
