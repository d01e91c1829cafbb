"""Bunching of consecutive vehicles: near each other on the same route and direction, and much closer in time than scheduled."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tramline.functions.geo import displacement_meters
from tramline.functions.times import nearest_anchor, schedule_offset, seconds_between
from tramline.operators.asof import latest_before
from tramline.settings import AGENCY_ZONE

#: The leader's position counts as known for so long.
KNOWN_SECONDS = 600


def stop_passes(pings: DataFrame, trips: DataFrame, stop_times: DataFrame, zone: str = AGENCY_ZONE, ts: str = "timestamp") -> DataFrame:
    """A trip's first ping at each stop and local day, with its route, direction, position and scheduled instant.

    A trip that the schedule has no stop time for has a pass without one. trips has each trip once, stop_times each
    (trip_id, stop_sequence) once.
    """
    rows = pings.filter("trip_id IS NOT NULL AND stop_id IS NOT NULL AND vehicle_id IS NOT NULL AND current_stop_sequence IS NOT NULL").filter(F.col(ts).isNotNull())
    day = F.from_utc_timestamp(ts, zone).cast("date").alias("day")
    first = rows.groupBy("trip_id", "vehicle_id", "stop_id", F.col("current_stop_sequence").alias("stop_sequence"), day)
    first = first.agg(F.min(F.struct(F.col(ts).alias("passed_at"), "lat", "lon")).alias("p")).select("*", "p.*").drop("p")
    rows = first.join(trips.select("trip_id", "route_id", "direction_id"), "trip_id")
    times = stop_times.select("trip_id", "stop_sequence", F.coalesce("arrival_time", "departure_time").alias("_time"))
    rows = rows.join(times, ["trip_id", "stop_sequence"], "left")
    return rows.withColumn("scheduled", nearest_anchor(F.col("passed_at"), schedule_offset(F.col("_time")), zone)).drop("_time")


def headways(passes: DataFrame) -> DataFrame:
    """Each pass with the one before it at the same stop, route, direction and day, of another vehicle: `leader`.

    Position along the route is the stop; passes in order of time are the vehicles in order there. Windows hold a day's
    passes of one stop. Equal times count in order of vehicle and trip.
    """
    w = Window.partitionBy("route_id", "direction_id", "stop_id", "day").orderBy("passed_at", "vehicle_id", "trip_id", "stop_sequence")
    leader = F.lag(F.struct("vehicle_id", "trip_id", "passed_at", "scheduled")).over(w)
    rows = passes.withColumn("leader", leader).filter(F.col("leader.vehicle_id") != F.col("vehicle_id"))
    return rows.withColumn("headway_seconds", seconds_between(F.col("leader.passed_at"), F.col("passed_at"))).withColumn("scheduled_headway_seconds", seconds_between(F.col("leader.scheduled"), F.col("scheduled")))


def bunched(pings: DataFrame, trips: DataFrame, stop_times: DataFrame, meters: float, ratio: float, zone: str = AGENCY_ZONE, ts: str = "timestamp", known: int = KNOWN_SECONDS) -> DataFrame:
    """Consecutive vehicles within `meters` of each other whose headway is below `ratio` of the scheduled one.

    The leader is where its latest ping puts it when the follower comes to the stop, `known` seconds old at most. Pairs
    without a scheduled headway above 0 are not judged. Both thresholds are the caller's, from spacing that was observed.
    """
    pairs = headways(stop_passes(pings, trips, stop_times, zone, ts)).filter("scheduled_headway_seconds > 0")
    pairs = pairs.withColumn("headway_ratio", F.col("headway_seconds") / F.col("scheduled_headway_seconds")).filter(F.col("headway_ratio") < ratio)
    pairs = pairs.select("route_id", "direction_id", "stop_id", F.col("leader.vehicle_id").alias("leader"), F.col("vehicle_id").alias("follower"), "passed_at", "lat", "lon", "headway_seconds", "scheduled_headway_seconds", "headway_ratio")
    places = pings.filter("lat IS NOT NULL AND lon IS NOT NULL").select(F.col("vehicle_id").alias("leader"), F.col(ts).alias("_seen"), F.col("lat").alias("_lat"), F.col("lon").alias("_lon"))
    rows = latest_before(pairs, places, ["leader"], "passed_at", "_seen", known, "_place")
    rows = rows.withColumn("meters", displacement_meters(F.col("_place._lat"), F.col("_place._lon"), F.col("lat"), F.col("lon")))
    return rows.filter(F.col("meters") <= meters).drop("_place", "lat", "lon")
