"""The agency's own arrival predictions against what happened."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tramline.functions.times import nearest_anchor, schedule_offset, seconds_between
from tramline.operators.asof import latest_before
from tramline.settings import AGENCY_ZONE

#: A prediction older than this says nothing about an arrival.
FRESH_SECONDS = 7200


def stop_updates(entities: DataFrame) -> DataFrame:
    """(trip_id, made_at, stop_sequence, delay, predicted_time, relationship, trip_delay) of trip updates in a decoded feed.

    Arrival counts before departure. An update without stops is one row without a sequence, as it may have a delay for
    the whole trip.
    """
    u = F.col("trip_update")
    rows = entities.filter(u.isNotNull()).select(
        u["trip"]["trip_id"].alias("trip_id"),
        F.timestamp_seconds(u["timestamp"].try_cast("long")).alias("made_at"),
        u["delay"].alias("trip_delay"),
        F.explode_outer(u["stop_time_update"]).alias("s"),
    )
    s = F.col("s")
    times = [s[end]["time"].try_cast("long") for end in ("arrival", "departure")]
    return rows.select(
        "trip_id",
        "made_at",
        s["stop_sequence"].alias("stop_sequence"),
        F.coalesce(s["arrival"]["delay"], s["departure"]["delay"]).alias("delay"),
        F.timestamp_seconds(F.coalesce(*times)).alias("predicted_time"),
        s["schedule_relationship"].alias("relationship"),
        "trip_delay",
    )


def predicted_arrivals(updates: DataFrame, stop_times: DataFrame, zone: str = AGENCY_ZONE) -> DataFrame:
    """(trip_id, stop_sequence, made_at, predicted_time): what each update says about all stops of its trip.

    A stop without an update of its own has the delay of the last stop before that has one; before the first, the trip's
    delay. NO_DATA ends that until the next delay; a SKIPPED stop has no prediction and the delay goes on. The scheduled
    instant is the one nearest the time of the update. Stops without any delay have no row, and neither do trips that
    the schedule doesn't have. stop_times has each (trip_id, stop_sequence) once.
    """
    messages = updates.filter("trip_id IS NOT NULL AND made_at IS NOT NULL").groupBy("trip_id", "made_at").agg(F.max("trip_delay").alias("trip_delay"))
    own = updates.filter("stop_sequence IS NOT NULL").groupBy("trip_id", "made_at", "stop_sequence")
    own = own.agg(F.max(F.struct("predicted_time", "delay", "relationship")).alias("_own"))
    stops = stop_times.select("trip_id", "stop_sequence", F.coalesce("arrival_time", "departure_time").alias("_time"))
    rows = messages.join(stops, "trip_id").join(own, ["trip_id", "made_at", "stop_sequence"], "left")
    rows = rows.withColumn("_scheduled", nearest_anchor(F.col("made_at"), schedule_offset(F.col("_time")), zone))
    relation = F.coalesce(F.col("_own.relationship"), F.lit("SCHEDULED"))
    delay = F.coalesce(seconds_between(F.col("_scheduled"), F.col("_own.predicted_time")), F.col("_own.delay").cast("long"))
    told = F.when(relation == "NO_DATA", F.struct(F.lit(None).cast("long").alias("delay"))).when(delay.isNotNull(), F.struct(delay.alias("delay")))
    w = Window.partitionBy("trip_id", "made_at").orderBy("stop_sequence").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    carried = F.coalesce(F.last(told, ignorenulls=True).over(w), F.struct(F.col("trip_delay").cast("long").alias("delay")))
    rows = rows.withColumn("_carried", carried).withColumn("_skipped", relation == "SKIPPED")
    rows = rows.withColumn("predicted_time", F.timestamp_seconds(F.unix_seconds("_scheduled") + F.col("_carried.delay")))
    return rows.filter("NOT _skipped AND predicted_time IS NOT NULL").select("trip_id", "stop_sequence", "made_at", "predicted_time")


def arrivals(pings: DataFrame, zone: str = AGENCY_ZONE, ts: str = "timestamp") -> DataFrame:
    """(trip_id, stop_sequence, day, actual_time): when a trip was first seen stopped at each of its stops, each local day."""
    day = F.from_utc_timestamp(ts, zone).cast("date")
    rows = pings.filter("trip_id IS NOT NULL AND current_stop_sequence IS NOT NULL AND current_status = 'STOPPED_AT'").filter(F.col(ts).isNotNull())
    return rows.groupBy("trip_id", F.col("current_stop_sequence").alias("stop_sequence"), day.alias("day")).agg(F.min(ts).alias("actual_time"))


def judged(predicted: DataFrame, made: DataFrame, within: int = FRESH_SECONDS) -> DataFrame:
    """Each arrival with the last prediction made at or before it: minutes_ahead, and error_seconds (actual after predicted is positive).

    Arrivals that no prediction was made for within `within` seconds go.
    """
    rows = latest_before(made, predicted, ["trip_id", "stop_sequence"], "actual_time", "made_at", within, "prediction").filter("prediction IS NOT NULL")
    ahead = F.floor(seconds_between(F.col("prediction.made_at"), F.col("actual_time")) / 60)
    error = seconds_between(F.col("prediction.predicted_time"), F.col("actual_time"))
    return rows.select("trip_id", "stop_sequence", "actual_time", F.col("prediction.made_at").alias("made_at"), F.col("prediction.predicted_time").alias("predicted_time"), ahead.alias("minutes_ahead"), error.alias("error_seconds"))


def prediction_error(rows: DataFrame) -> DataFrame:
    """Errors by how far ahead the prediction was made, in minutes."""
    e = F.col("error_seconds")
    return rows.groupBy("minutes_ahead").agg(F.count("*").alias("n"), F.round(F.avg(e), 6).alias("mean_error"), F.round(F.avg(F.abs(e)), 6).alias("mean_abs_error"))
