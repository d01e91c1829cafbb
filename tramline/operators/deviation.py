"""Schedule deviation: pings joined to their stop times, the scheduled instant nearest each, and the difference."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tramline.functions.times import exact_seconds_between, nearest_anchor, schedule_hour, schedule_offset
from tramline.settings import AGENCY_ZONE

EXTREME_SECONDS = 7200


def midnight_crossers(stop_times: DataFrame, trips: DataFrame) -> DataFrame:
    """Distinct trips of interest with an hour of 24 or more."""
    late = (schedule_hour(F.col("arrival_time")) >= 24) | (schedule_hour(F.col("departure_time")) >= 24)
    return stop_times.filter(late).join(trips.select("trip_id").distinct(), "trip_id", "left_semi").select("trip_id").distinct()


def scheduled(pings: DataFrame, stop_times: DataFrame) -> DataFrame:
    """Pings with a stop, with the arrival and departure of their trip's stop in sequence.

    The key is the sequence, not the stop, as a loop visits stops again. Repeated keys in the schedule fan out.
    """
    times = stop_times.select("trip_id", F.col("stop_sequence").alias("current_stop_sequence"), "arrival_time", "departure_time")
    return pings.filter("stop_id IS NOT NULL").join(times, ["trip_id", "current_stop_sequence"])


def deviations(pings: DataFrame, stop_times: DataFrame, zone: str = AGENCY_ZONE, actual: str = "timestamp") -> DataFrame:
    """scheduled_time_str (arrival, else departure), scheduled_datetime and deviation_seconds: positive is late."""
    rows = scheduled(pings, stop_times).withColumn("scheduled_time_str", F.coalesce("arrival_time", "departure_time"))
    rows = rows.na.drop(subset=["scheduled_time_str"])
    rows = rows.withColumn("scheduled_datetime", nearest_anchor(F.col(actual), schedule_offset(F.col("scheduled_time_str")), zone))
    return rows.withColumn("deviation_seconds", exact_seconds_between(F.col("scheduled_datetime"), F.col(actual)))


def extreme(rows: DataFrame, seconds: float = EXTREME_SECONDS) -> DataFrame:
    return rows.filter(F.abs("deviation_seconds") > seconds)


def extreme_share(rows: DataFrame, seconds: float = EXTREME_SECONDS) -> DataFrame:
    n, of = F.count_if(F.abs("deviation_seconds") > seconds), F.count("*")
    return rows.agg(n.alias("n_extreme"), of.alias("n_deviations"), F.round(100 * F.try_divide(n, of), 6).alias("pct_extreme"))
