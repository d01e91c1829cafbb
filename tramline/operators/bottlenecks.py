"""Bottlenecks: places where vehicles are often slow, joined into clusters."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tramline.checkpoints import checkpointed

#: A cell is dense from so many slow gaps on, if they are such a share of its gaps.
SLOW_LEAST, SLOW_SHARE = 3, 0.5
#: Cells are numbered row by row.
ROW = 1 << 31


def dense_cells(cells: DataFrame, least: int = SLOW_LEAST, share: float = SLOW_SHARE) -> DataFrame:
    """The cells of extensions.slow_cells in which vehicles are slow often enough."""
    return cells.filter((F.col("n_slow") >= least) & (F.col("n_slow") >= share * F.col("n")))


def clusters(cells: DataFrame) -> DataFrame:
    """cells (cell_lat, cell_lon, ...; each once) with cluster_lat, cluster_lon: the least cell that can be reached over neighbours.

    Neighbours share a side or a corner. Each round a cell takes the least label among its neighbours' and then its
    label's own label, so labels travel in growing steps; the rounds end when none changes. Tables are written between
    rounds and only the number of changes comes to the driver. Work grows with the number of cells, not of pings.
    """
    number = (F.col("cell_lat") * ROW + F.col("cell_lon") + ROW // 2).alias("_cell")
    rows = checkpointed(cells.select("*", number))
    steps = F.array(*[F.lit(y * ROW + x) for y in (-1, 0, 1) for x in (-1, 0, 1) if x or y])
    own = rows.select("_cell")
    beside = rows.select("_cell", F.explode(F.transform(steps, lambda s: F.col("_cell") + s)).alias("_beside"))
    edges = checkpointed(beside.join(own.withColumnRenamed("_cell", "_beside"), "_beside", "left_semi"))
    labels = own.withColumn("_label", F.col("_cell"))
    while True:
        near = edges.join(labels.withColumnRenamed("_cell", "_beside"), "_beside").groupBy("_cell").agg(F.min("_label").alias("_near"))
        met = labels.join(near, "_cell", "left").select("_cell", F.least("_label", F.coalesce("_near", "_label")).alias("_to"), F.col("_label").alias("_was"))
        onward = labels.select(F.col("_cell").alias("_to"), F.col("_label").alias("_onward"))
        found = checkpointed(met.join(onward, "_to").select("_cell", F.least("_to", "_onward").alias("_label"), "_was"))
        changed = found.filter("_label <> _was").limit(1).count()
        labels = found.select("_cell", "_label")
        if not changed:
            break
    lat = F.floor(F.col("_label") / ROW)
    out = rows.join(labels, "_cell")
    return out.withColumns({"cluster_lat": lat, "cluster_lon": F.col("_label") - lat * ROW - ROW // 2}).drop("_cell", "_label")


def bottlenecks(cells: DataFrame) -> DataFrame:
    """One row for each cluster: its cells, gaps, slow gaps, and mean speed over all its gaps."""
    by = clusters(dense_cells(cells)).groupBy("cluster_lat", "cluster_lon")
    mean = F.sum(F.col("mean_mps") * F.col("n")) / F.sum("n")
    return by.agg(F.count("*").alias("n_cells"), F.sum("n").alias("n"), F.sum("n_slow").alias("n_slow"), F.round(mean, 6).alias("mean_mps"))
