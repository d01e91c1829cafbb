"""Stops: enrichment, coverage, sequence consistency, and what a schedule could fill in."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def enriched(pings: DataFrame, stops: DataFrame) -> DataFrame:
    """Pings with their stop's columns; those without a known stop stay. Spark broadcasts stops if their size allows."""
    return pings.join(stops, "stop_id", "left")


def coverage(pings: DataFrame) -> DataFrame:
    n, of = F.count("stop_id"), F.count("*")
    return pings.agg(n.alias("n_with_stop"), of.alias("n_pings"), F.round(100 * F.try_divide(n, of), 6).alias("pct_with_stop"))


def sequence_steps(pings: DataFrame, tiebreak: str | None = None) -> DataFrame:
    """Pings with a sequence, and seq_diff: the change since the trip's ping before. NULL without a trip or a ping before."""
    order = [F.asc_nulls_last("timestamp"), *([tiebreak] if tiebreak else [])]
    w = Window.partitionBy("vehicle_id", "trip_id").orderBy(*order)
    rows = pings.na.drop(subset=["current_stop_sequence"])
    return rows.withColumn("seq_diff", F.when(F.col("trip_id").isNotNull(), F.col("current_stop_sequence") - F.lag("current_stop_sequence").over(w)))


def backward_share(steps: DataFrame) -> DataFrame:
    """Steps back, as a share of all pings with a sequence."""
    n, of = F.count_if(F.col("seq_diff") < 0), F.count("*")
    return steps.agg(n.alias("n_backwards"), of.alias("n_observations"), F.round(100 * F.try_divide(n, of), 6).alias("pct_backwards"))


def null_stop_trips(pings: DataFrame) -> DataFrame:
    return pings.filter("stop_id IS NULL AND trip_id IS NOT NULL").select("trip_id").distinct()


def feasibility(trips: DataFrame, stop_times: DataFrame) -> DataFrame:
    """Of distinct trips, those that the schedule has."""
    known = stop_times.select("trip_id").distinct().withColumn("known", F.lit(True))
    n, of = F.count("known"), F.count("*")
    found = trips.join(known, "trip_id", "left").agg(of.alias("total_null_stop_trips"), n.alias("resolvable_in_static_schedule"))
    return found.withColumn("pct_resolvable", F.round(100 * F.try_divide(F.col("resolvable_in_static_schedule"), F.col("total_null_stop_trips")), 6))


def without_shuttles(pings: DataFrame, prefix: str = "Shuttle-Generic", trip_prefix: str | None = None) -> DataFrame:
    """Pings of scheduled routes, by the names of route and trip (where a prefix is given); those without a name stay."""
    shuttle = F.col("route_id").startswith(prefix)
    rows = pings.filter(~F.coalesce(shuttle, F.lit(False)))
    return rows if trip_prefix is None else rows.filter(~F.coalesce(F.col("trip_id").startswith(trip_prefix), F.lit(False)))
