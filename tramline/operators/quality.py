"""Reporting gaps: dedup, gaps, dwells, correlated outages, and the threshold beyond which a vehicle is silent."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tramline.functions.geo import displacement_meters
from tramline.functions.times import exact_seconds_between, seconds_between
from tramline.operators import stats
from tramline.settings import POLL_SECONDS

DWELL_METERS = 50
OUTAGE_VEHICLES = 5
SWEEP = (0.75, 0.9, 0.95, 0.99)
GAP = "real_update_gap_seconds"


def with_day(pings: DataFrame) -> DataFrame:
    """_day, by which a vehicle's rows are dealt: its UTC day. Rows without a vehicle or a timestamp have none."""
    if "_day" in pings.columns:
        return pings
    return pings.withColumn("_day", F.when(F.col("vehicle_id").isNotNull(), F.unix_date(F.col("timestamp").cast("date"))))


def order_of_rows(pings: DataFrame, tiebreak: Sequence[str] = ()) -> list[Column]:
    """What the best of alike rows has most of: ingestion time (where reported), then the tiebreak, then the row hash. NULL is least."""
    return [*map(F.col, [c for c in ("ingested_at",) if c in pings.columns]), *map(F.col, tiebreak), F.xxhash64(*pings.columns)]


def latest(pings: DataFrame, tiebreak: Sequence[str] = (), days: bool = False) -> DataFrame:
    """One row for each (vehicle_id, timestamp): the latest ingested, then the greatest tiebreak, then the greatest row hash.

    Rows are dealt by vehicle and day, so that no vehicle's history has to fit one task and there may be more tasks than
    vehicles. days: `_day` stays, and `gaps` then needs no shuffle of its own.
    """
    order = [c.desc_nulls_last() for c in order_of_rows(pings, tiebreak)]
    w = Window.partitionBy("vehicle_id", "_day", "timestamp").orderBy(*order)
    out = with_day(pings).repartition("vehicle_id", "_day").withColumn("_n", F.row_number().over(w)).filter("_n = 1")
    return out.drop("_n") if days else out.drop("_n", "_day")


def dedup_report(pings: DataFrame, key: Sequence[str] = ("vehicle_id", "timestamp")) -> DataFrame:
    """One row: rows, rows after dedup, and the percentage removed. Counts are combined by key, then summed."""
    by = pings.groupBy(*key).agg(F.count("*").alias("n"))
    rows, kept = F.coalesce(F.sum("n"), F.lit(0)), F.count("*")
    return by.agg(rows.alias("n_rows"), kept.alias("n_deduped"), F.round(100 * (1 - F.try_divide(kept, rows)), 6).alias("pct_removed"))


BEFORE = {"timestamp": "prev_timestamp", "lat": "prev_lat", "lon": "prev_lon", "current_status": "prev_status"}


def day_ends(pings: DataFrame, tiebreak: Sequence[str] = ()) -> DataFrame:
    """(vehicle_id, _day, _before): for each day with pings, the vehicle's last ping of its days before.

    The last ping of a day is found with rows combined before the shuffle. Raw pings give the same as deduplicated ones,
    if the tiebreak is the same.
    """
    last = F.max_by(F.struct(*BEFORE), F.struct("timestamp", *order_of_rows(pings, tiebreak)))
    ends = with_day(pings).filter("_day IS NOT NULL").groupBy("vehicle_id", "_day").agg(last.alias("_last"))
    w = Window.partitionBy("vehicle_id").orderBy("_day")
    return ends.select("vehicle_id", "_day", F.lag("_last").over(w).alias("_before")).filter("_before IS NOT NULL")


def gaps(pings: DataFrame, ends: DataFrame | None = None) -> DataFrame:
    """Each ping with its vehicle's one before, and the seconds between; first pings go.

    Windows are by vehicle and day; a day's first ping gets its ping before from `ends` (see day_ends), which are few
    rows. They are taken from the pings themselves if not given.
    """
    ends = day_ends(pings) if ends is None else ends
    ends = ends.withColumnsRenamed({"vehicle_id": "_vehicle"}).withColumnRenamed("_day", "_of")
    w = Window.partitionBy("vehicle_id", "_day").orderBy("timestamp")
    rows = with_day(pings)
    rows = rows.withColumns({name: F.lag(c).over(w) for c, name in BEFORE.items()} | {"_n": F.row_number().over(w)})
    rows = rows.join(ends, (F.col("vehicle_id") == F.col("_vehicle")) & (F.col("_day") == F.col("_of")), "left")
    first = F.col("_n") == 1
    rows = rows.withColumns({name: F.when(first, F.col("_before")[c]).otherwise(F.col(name)) for c, name in BEFORE.items()})
    return rows.withColumn(GAP, seconds_between(F.col("prev_timestamp"), F.col("timestamp"))).na.drop(subset=[GAP]).drop("_day", "_n", "_vehicle", "_of", "_before")


def with_dwell(gap_rows: DataFrame, meters: float = DWELL_METERS) -> DataFrame:
    """displacement_meters, and likely_dwell: hardly moved, and stopped at either end. Unknown counts as no dwell."""
    out = gap_rows.withColumn("displacement_meters", displacement_meters(F.col("prev_lat"), F.col("prev_lon"), F.col("lat"), F.col("lon")))
    moved_little = F.coalesce(F.col("displacement_meters") <= meters, F.lit(False)) & ~F.coalesce(F.isnan("displacement_meters"), F.lit(False))
    stopped = F.coalesce(F.col("current_status") == "STOPPED_AT", F.lit(False)) | F.coalesce(F.col("prev_status") == "STOPPED_AT", F.lit(False))
    return out.withColumn("likely_dwell", moved_little & stopped)


def movement(dwell_rows: DataFrame) -> DataFrame:
    return dwell_rows.filter("NOT likely_dwell")


def dwells(dwell_rows: DataFrame) -> DataFrame:
    return dwell_rows.filter("likely_dwell")


def dwell_share(dwell_rows: DataFrame) -> DataFrame:
    n, of = F.count_if("likely_dwell"), F.count("*")
    return dwell_rows.agg(n.alias("n_dwell"), of.alias("n_gaps"), F.round(100 * F.try_divide(n, of), 6).alias("pct_dwell"))


def threshold(gap_rows: DataFrame, q: float = 0.99, poll_seconds: float = POLL_SECONDS) -> DataFrame:
    """One row: the quantile of the gaps, and that plus one poll, the silent-vehicle threshold."""
    found = F.col("_q")[0]
    return stats.quantiles_by_rank(gap_rows, GAP, [q]).select(F.round(found, 6).alias("gap_quantile"), F.round(found + poll_seconds, 6).alias("threshold_seconds"))


def large_gaps(gap_rows: DataFrame, qs: Sequence[float], bucket: str) -> DataFrame:
    """(cutoff_quantile, cutoff, vehicle_id, minute): gaps at or over each quantile, by the time bucket they began in.

    The cutoffs are one row for each quantile, joined by broadcast as there are len(qs) of them.
    """
    cuts = stats.quantiles_by_rank(gap_rows, GAP, qs)
    pairs = F.arrays_zip(F.array(*map(F.lit, qs)).alias("q"), F.col("_q").alias("c"))
    cuts = cuts.select(F.filter(pairs, lambda x: x["c"].isNotNull()).alias("cuts"))
    rows = gap_rows.select("vehicle_id", "prev_timestamp", GAP).join(F.broadcast(cuts), F.lit(True))
    over = F.filter("cuts", lambda x: F.col(GAP) >= x["c"])
    rows = rows.select("vehicle_id", F.date_trunc(bucket, "prev_timestamp").alias("minute"), F.explode(over).alias("x"))
    return rows.select(F.col("x.q").alias("cutoff_quantile"), F.col("x.c").alias("cutoff"), "vehicle_id", "minute")


def cluster_sweep(gap_rows: DataFrame, qs: Sequence[float] = SWEEP, bucket: str = "minute") -> DataFrame:
    """For each cutoff quantile: its seconds, the large gaps, and the most vehicles with one in the same time bucket.

    Ties for the busiest bucket go to the earliest. All quantiles are one plan.
    """
    by = large_gaps(gap_rows, qs, bucket).groupBy("cutoff_quantile", "cutoff", "minute").agg(F.count("*").alias("n"), F.count_distinct("vehicle_id").alias("v"))
    first = F.max_by("minute", F.struct(F.col("v"), -F.unix_seconds("minute")))
    return by.groupBy("cutoff_quantile").agg(
        F.round(F.first("cutoff"), 1).alias("cutoff_seconds"), F.sum("n").alias("n_large_gaps"), F.coalesce(F.max("v"), F.lit(0)).alias("max_vehicles_in_one_minute"), first.alias("busiest_minute")
    )


def flagged(sweep: DataFrame, vehicles: int = OUTAGE_VEHICLES) -> DataFrame:
    """The cutoffs at which so many vehicles fell silent together."""
    return sweep.filter(F.col("max_vehicles_in_one_minute") >= vehicles)


def suspect_minutes(gap_rows: DataFrame, q: float = 0.99, vehicles: int = OUTAGE_VEHICLES, bucket: str = "minute") -> DataFrame:
    by = large_gaps(gap_rows, [q], bucket).groupBy("minute").agg(F.count_distinct("vehicle_id").alias("n_vehicles"))
    return by.filter(F.col("n_vehicles") >= vehicles)


def seconds_of(bucket: str) -> int:
    return {"minute": 60, "hour": 3600, "day": 86_400}[bucket]


def outage_window(gap_rows: DataFrame, q: float = 0.99, vehicles: int = OUTAGE_VEHICLES, bucket: str = "minute") -> DataFrame:
    """One row: first and last suspect minute (NULL without any), their number, and whether none between is missing.

    Suspect minutes are distinct, so they are contiguous just if they fill the span; no ordering is needed.
    """
    found = suspect_minutes(gap_rows, q, vehicles, bucket)
    start, end, n = F.min("minute"), F.max("minute"), F.count("*")
    full = seconds_between(start, end) / seconds_of(bucket) + 1 == n
    return found.agg(start.alias("window_start"), end.alias("window_end"), n.alias("n_minutes"), F.coalesce(full, F.lit(False)).alias("is_contiguous"))


def outside_outage(gap_rows: DataFrame, window: DataFrame, bucket: str = "minute") -> DataFrame:
    """Gaps that began outside the window, whose end is one bucket after its last minute, both ends included.

    The window is one row.
    """
    at = F.unix_micros("prev_timestamp")
    inside = at.between(F.unix_micros("window_start"), F.unix_micros("window_end") + seconds_of(bucket) * 1_000_000)
    rows = gap_rows.join(F.broadcast(window.select("window_start", "window_end")), F.lit(True))
    return rows.filter(~F.coalesce(inside, F.lit(False))).drop("window_start", "window_end")


def clean_threshold(gap_rows: DataFrame, q: float = 0.99, vehicles: int = OUTAGE_VEHICLES, bucket: str = "minute") -> DataFrame:
    """The silent-vehicle threshold from movement gaps without the outage."""
    return threshold(outside_outage(gap_rows, outage_window(gap_rows, q, vehicles, bucket), bucket))


def null_rate_by_route(pings: DataFrame, column: str = "stop_id") -> DataFrame:
    """Rows with and without the column by route; rows without a route are a group."""
    by = pings.groupBy("route_id").agg(F.count(column).alias("reported"), F.count("*").alias("total"))
    return by.withColumn("pct_missing", F.round(1.0 - F.col("reported") / F.col("total"), 6))


def status_distribution(pings: DataFrame) -> DataFrame:
    """Percentage of each reported status."""
    by = pings.filter("current_status IS NOT NULL").groupBy("current_status").agg(F.count("*").alias("n"))
    return by.withColumn("pct", F.round(100 * F.col("n") / F.sum("n").over(Window.partitionBy(F.lit(1))), 6))


def with_latency(pings: DataFrame) -> DataFrame:
    return pings.withColumn("latency_seconds", exact_seconds_between(F.col("timestamp"), F.col("ingested_at")))


def definitive(status: Column) -> Column:
    """Only a stop is a definite status; the others pass."""
    return F.coalesce(status == "STOPPED_AT", F.lit(False))
