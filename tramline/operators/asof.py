"""As-of join: each row with the latest row of the other side at or before its time."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def latest_before(left: DataFrame, right: DataFrame, keys: Sequence[str], left_time: str, right_time: str, within: int, name: str = "found") -> DataFrame:
    """left with `name`, a struct of the right row's other columns: the latest of its keys at or before left_time, by `within` seconds at most.

    NULL where there is none. Of right rows at one time the greatest counts, column by column. Left rows without a time
    or a key have no match, and stay.

    Both sides fall into time buckets of `within` seconds, right rows into the one after theirs too, so a match is
    always in the left row's bucket. Windows are by key and bucket: a key's history is spread over tasks.
    """
    rest = [c for c in right.columns if c not in keys]

    def bucket(time: str):
        return F.floor(F.unix_micros(time) / (within * 1_000_000))

    usable = F.col(right_time).isNotNull()
    for k in keys:
        usable = usable & F.col(k).isNotNull()
    b = bucket(right_time)
    r = right.filter(usable).select(*keys, F.explode(F.array(b, b + 1)).alias("_b"), F.unix_micros(right_time).alias("_t"), F.lit(0).alias("_side"), F.struct(*rest).alias(name))
    rows = left.select(*keys, bucket(left_time).alias("_b"), F.unix_micros(left_time).alias("_t"), F.lit(1).alias("_side"), F.struct(*left.columns).alias("_left"))
    rows = rows.unionByName(r, allowMissingColumns=True)
    w = Window.partitionBy(*keys, "_b").orderBy("_t", "_side", name).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    last = F.last(F.when(F.col("_side") == 0, F.struct("_t", name)), ignorenulls=True).over(w)
    rows = rows.withColumn("_last", last).filter("_side = 1")
    near = F.col("_t") - F.col("_last._t") <= within * 1_000_000
    return rows.select("_left.*", F.when(near, F.col(f"_last.{name}")).alias(name))
