"""Durations and schedule times, in epoch seconds. The session's zone is UTC (see plans.tables.utc)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

HALF_DAY, DAY = 43_200, 86_400


def seconds_between(start: Column, end: Column) -> Column:
    """Second boundaries between two instants."""
    return F.unix_seconds(end) - F.unix_seconds(start)


def exact_seconds_between(start: Column, end: Column) -> Column:
    return (F.unix_micros(end) - F.unix_micros(start)) / F.lit(1e6)


def iso_utc(ts: Column) -> Column:
    """ISO-8601 with milliseconds and Z."""
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")


def schedule_offset(text: Column) -> Column:
    """Seconds of an H:MM:SS schedule time; hours may pass 24, parts may have blanks, anything else is NULL."""
    part = F.split(text, ":")
    number = [F.trim(F.get(part, F.lit(k))).try_cast("int") for k in range(3)]
    return F.when(F.size(part) == 3, number[0] * 3600 + number[1] * 60 + number[2]).cast("long")


def schedule_hour(text: Column) -> Column:
    return F.split_part(text, F.lit(":"), F.lit(1)).try_cast("int")


def local_midnight(ts: Column, zone: str) -> Column:
    """Epoch seconds of the midnight that begins the instant's local day."""
    if zone == "UTC":
        return F.unix_seconds(ts) - F.pmod(F.unix_seconds(ts), F.lit(DAY))
    # a timestamp shifted to local wall time, cut to its day there, and shifted back
    return F.unix_seconds(F.to_utc_timestamp(F.date_trunc("DAY", F.from_utc_timestamp(ts, zone)), zone))


def nearest_anchor(actual: Column, offset: Column, zone: str) -> Column:
    """The scheduled instant nearest `actual` with this offset from the midnight of its day, or 24 hours before or after.

    Equally near: the same day, then the day before. Offsets are elapsed seconds, also on days of a clock change.
    """
    same = local_midnight(actual, zone) + offset
    now = F.unix_micros(actual)
    options = [F.struct(F.abs(now - (same + shift) * 1_000_000).alias("gap"), F.lit(rank).alias("rank"), (same + shift).alias("at")) for rank, shift in enumerate((0, -DAY, DAY))]
    return F.timestamp_seconds(F.when(offset.isNotNull() & actual.isNotNull(), F.array_min(F.array(*options))["at"]))
