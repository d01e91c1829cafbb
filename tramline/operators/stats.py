"""Exact descriptive statistics, of all rows or by group. Quantiles interpolate linearly.

Quantiles are found by rank, so no task or aggregation buffer ever holds all values of a group. Equal values are counted
first, combined before the shuffle. The counts fall into bins of equal ratio, 65,536 for each doubling, and prefix sums
over a group's bins tell which ones hold the wanted ranks. Only the values of these bins go on, to a window that sorts
them. Bins never fall as values rise, so the ranks are exact.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

DIGITS = 6
PER_DOUBLING = 1 << 16
#: Beyond the bins of all finite numbers (some 2,100 doublings).
BIN_MOST = 1 << 30


def quantile_name(q: float) -> str:
    return f"p{q * 100:g}".replace(".", "_")


def bin_of(x: Column) -> Column:
    """A whole number that never falls as x rises; infinities and NaN, the largest, have bins of their own."""
    size = F.floor(F.log2(F.abs(x)) * PER_DOUBLING) + BIN_MOST // 2
    finite = F.when(x == 0, F.lit(0)).when(x > 0, size).otherwise(-size)
    return F.when(F.isnan(x), F.lit(BIN_MOST + 1)).when(F.abs(x) == float("inf"), F.signum(x) * BIN_MOST).otherwise(finite).cast("long")


def matched(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Joins on keys that may be NULL; the right side's keys go."""
    own = {k: f"_right_{k}" for k in keys}
    on = F.lit(True)
    for k, r in own.items():
        on = on & left[k].eqNullSafe(F.col(r))
    return left.join(right.withColumnsRenamed(own), on).drop(*own.values())


def group_window(by: Sequence[str]) -> WindowSpec:
    return Window.partitionBy(*by) if by else Window.partitionBy(F.lit(1))


def ranks_of(qs: Sequence[float], total: Column) -> Column:
    """For each quantile, the ranks (from 0) of the two values that it lies between, and how far between."""
    at = [(total - 1) * q for q in qs]
    ends = [F.struct(F.lit(2 * k + up).alias("t"), (F.ceil(x) if up else F.floor(x)).alias("r"), (x - F.floor(x)).alias("between")) for k, x in enumerate(at) for up in (0, 1)]
    return F.array(*ends)


def inside(before: Column, n: Column, rank: Column) -> Column:
    return (rank >= before) & (rank < before + n)


def quantiles_by_rank(df: DataFrame, column: str, qs: Sequence[float], by: Sequence[str] = ()) -> DataFrame:
    """The group's columns and `_q`, an array with a value for each quantile of the non-null values, NULL without any.

    Groups may be NULL. Without `by` there is just one row, also of an empty table.
    """
    counts = df.groupBy(*by, F.col(column).cast("double").alias("_x")).agg(F.count("*").alias("_n"))
    counts = counts.withColumn("_bin", bin_of(F.col("_x")))
    # ranks to bins; the bin of NULL has no ranks, and keeps groups that have nothing else
    size = F.when(F.col("_bin").isNotNull(), F.col("_n")).otherwise(0)
    bins = counts.groupBy(*by, "_bin").agg(F.sum(size).alias("_n"))
    w = group_window(by)
    bins = bins.withColumns({"_before": F.coalesce(F.sum("_n").over(w.orderBy("_bin").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)), "_total": F.sum("_n").over(w)})
    wanted = F.filter(ranks_of(qs, F.col("_total")), lambda x: inside(F.col("_before"), F.col("_n"), x["r"]))
    chosen = bins.select(*by, "_bin", "_before", F.explode_outer(wanted).alias("_w")).filter("_w IS NOT NULL OR _bin IS NULL")
    chosen = chosen.select(*by, "_bin", F.col("_w.t").alias("_t"), F.col("_w.between").alias("_between"), (F.col("_w.r") - F.col("_before")).alias("_r"))
    # ranks to values; without groups, two rows for each quantile at most are chosen, so they are broadcast
    rows = matched(counts, chosen if by else F.broadcast(chosen), [*by, "_bin"])
    w = Window.partitionBy(*by, "_t").orderBy("_x").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("_before", F.coalesce(F.sum("_n").over(w), F.lit(0)))
    rows = rows.filter(F.col("_t").isNull() | inside(F.col("_before"), F.col("_n"), F.col("_r")))
    ends = [F.max(F.when(F.col("_t") == t, F.col("_x"))).alias(f"_v{t}") for t in range(2 * len(qs))]
    share = [F.max(F.when(F.col("_t") == 2 * k, F.col("_between"))).alias(f"_s{k}") for k in range(len(qs))]
    found = rows.groupBy(*by).agg(*ends, *share)
    values = []
    for k in range(len(qs)):
        lo, hi = F.col(f"_v{2 * k}"), F.col(f"_v{2 * k + 1}")
        values.append(F.when(lo == hi, lo).otherwise(lo + (hi - lo) * F.col(f"_s{k}")))
    return found.select(*by, F.array(*values).alias("_q"))


def quantiles(df: DataFrame, column: str, qs: Sequence[float], by: Sequence[str] = (), digits: int = DIGITS) -> DataFrame:
    """A column for each quantile of the non-null values."""
    found = quantiles_by_rank(df, column, qs, by)
    return found.select(*by, *[F.round(F.col("_q")[k], digits).alias(quantile_name(q)) for k, q in enumerate(qs)])


def beside(totals: DataFrame, found: DataFrame, by: Sequence[str]) -> DataFrame:
    """Two tables with a row for each group side by side; without groups, their only rows."""
    return matched(totals, found, by) if by else totals.join(F.broadcast(found), F.lit(True))


def described(df: DataFrame, column: str, by: Sequence[str] = (), digits: int = DIGITS) -> DataFrame:
    """count, mean, sample deviation, min, quartiles and max of the non-null values."""
    x = F.col(column).cast("double")
    totals = df.groupBy(*by).agg(F.count(x).alias("count"), F.avg(x).alias("mean"), F.stddev_samp(x).alias("std"), F.min(x).alias("min"), F.max(x).alias("max"))
    found = beside(totals, quantiles_by_rank(df, column, (0.25, 0.5, 0.75), by), by)
    rounded = {c: F.round(c, digits) for c in ("mean", "std", "min", "max")} | {f"p{n}": F.round(F.col("_q")[k], digits) for k, n in enumerate((25, 50, 75))}
    return found.withColumns(rounded).select(*by, "count", "mean", "std", "min", "p25", "p50", "p75", "max")
