"""Feed entities to telemetry rows: what is rejected, why, and how the rest is reshaped."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Beyond this many seconds either way a date doesn't exist in the feed's clients; the row stays, without a timestamp.
DATE_LIMIT = 8.64e12


def finite(x: Column) -> Column:
    return x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))


def valid_position(lat: Column, lon: Column) -> Column:
    """Both finite and within the globe, ends included; never NULL."""
    ok = finite(lat) & finite(lon) & lat.between(-90, 90) & lon.between(-180, 180)
    return F.coalesce(ok, F.lit(False))


def epoch_seconds(text: Column) -> Column:
    """A number's text; blank text is 0; NULL for anything else."""
    number = F.when(F.trim(text) == "", F.lit(0.0)).otherwise(F.trim(text).try_cast("double"))
    return F.when(finite(number), number)


def reject_reason(entity: DataFrame) -> Column:
    """The first rule that fails (position, vehicle id, timestamp), or NULL."""
    place = F.col("vehicle.position")
    return (
        F.when(~valid_position(place["latitude"], place["longitude"]), "position")
        .when(~F.coalesce(F.col("vehicle.vehicle.id") != "", F.lit(False)), "vehicle_id")
        .when(epoch_seconds(F.col("vehicle.timestamp")).isNull(), "timestamp")
    )


def checked(entities: DataFrame) -> DataFrame:
    return entities.withColumn("reject_reason", reject_reason(entities))


def telemetry(entities: DataFrame) -> DataFrame:
    """The canonical rows of valid entities. Odd speeds and bearings are kept; what isn't reported is NULL."""
    v = "vehicle."
    seconds = epoch_seconds(F.col(v + "timestamp"))
    instant = F.when(F.abs(seconds) <= DATE_LIMIT, F.timestamp_millis((seconds * 1000).cast("long")))
    point = F.struct(F.lit("Point").alias("type"), F.array(v + "position.longitude", v + "position.latitude").alias("coordinates"))
    return (
        checked(entities)
        .filter("reject_reason IS NULL")
        .select(
            F.col(v + "vehicle.id").alias("vehicle_id"),
            F.col(v + "trip.trip_id").alias("trip_id"),
            F.col(v + "trip.route_id").alias("route_id"),
            point.alias("location"),
            instant.alias("timestamp"),
            F.col(v + "position.bearing").alias("bearing"),
            F.col(v + "position.speed").alias("speed"),
            F.col(v + "current_stop_sequence").alias("current_stop_sequence"),
            F.col(v + "stop_id").alias("stop_id"),
            F.col(v + "current_status").alias("current_status"),
        )
    )


def skipped(entities: DataFrame) -> DataFrame:
    """One row: entities, and how many are rejected."""
    return checked(entities).agg(F.count("*").alias("entities"), F.count("reject_reason").alias("skipped"))
