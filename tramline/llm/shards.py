"""Splitting keys that hold many rows, for work that pairs the rows of two tables under a key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tramline.llm.common import Scratch


def grid(scratch: Scratch, left: DataFrame, right: DataFrame, key: list[str], left_most: int, right_most: int, by: tuple[str, str], weight: tuple[str, str] = ("1", "1")) -> tuple[DataFrame, DataFrame]:
    """Both tables with gl and gr: every left row meets every right row of its key in just one (key, gl, gr).

    A key's left rows are dealt to ceil(weight / left_most) parts by the column by[0], each of which meets copies of all
    parts of its right rows, and the other way round. Keys without rows on both sides go. The parts' numbers come from
    counts combined before the shuffle and are a joined table, never collected.
    """
    sizes_l = left.groupBy(*key).agg(F.expr(f"CAST(ceil(sum({weight[0]}) / {left_most}) AS INT)").alias("_nl"))
    sizes_r = right.groupBy(*key).agg(F.expr(f"CAST(ceil(sum({weight[1]}) / {right_most}) AS INT)").alias("_nr"))
    sizes = scratch.keep(sizes_l.join(sizes_r, key), "sizes")

    def dealt(df: DataFrame, own: str, other: str, column: str) -> DataFrame:
        parts, copies = f"_n{own[1]}", f"_n{other[1]}"
        out = df.join(sizes, key).withColumn(own, F.expr(f"CAST(pmod(xxhash64({column}, 7), {parts}) AS INT)"))
        return out.withColumn(other, F.explode(F.expr(f"sequence(0, {copies} - 1)"))).drop("_nl", "_nr")

    return dealt(left, "gl", "gr", by[0]), dealt(right, "gr", "gl", by[1])
