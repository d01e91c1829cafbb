"""Queries by name over the transit views, and the same in DuckDB SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tramline.checkpoints import checkpointed, new_folder
from tramline.functions.times import schedule_offset
from tramline.operators import bottlenecks, bunching, deviation, extensions, predictions, quality, stats, stops, validate
from tramline.plans import tables as t
from tramline.sources import messages, store
from tramline.streaming import live

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}
#: Events are sparse, so outages are looked for by hour here; the feed's own bucket is a minute.
BUCKET = "hour"
NTZ = "timestamp_ntz"
GAP = quality.GAP
BASE = (t.PINGS, t.DEDUPED)
GAPS = (*BASE, t.LAGGED, t.GAPS)
MOVES = (*GAPS, t.DWELL, t.MOVES)
DEVIATIONS = (*BASE, t.STOP_TIMES, t.DEVIATIONS)


def query(select: str | None = None, *with_: str) -> Callable[[Query], Query]:
    def register(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if select is not None:
            ORACLES[f.__name__] = t.sql(select, *with_) if with_ else select
        return f

    return register


def deduped(spark: SparkSession, sf: str) -> DataFrame:
    return quality.latest(t.pings(spark, sf), ["event_id"])


def gap_rows(spark: SparkSession, sf: str) -> DataFrame:
    rows = t.pings(spark, sf)
    return quality.gaps(quality.latest(rows, ["event_id"], days=True), quality.day_ends(rows, ["event_id"]))


def dwell_rows(spark: SparkSession, sf: str) -> DataFrame:
    return quality.with_dwell(gap_rows(spark, sf))


def moves(spark: SparkSession, sf: str) -> DataFrame:
    return quality.movement(dwell_rows(spark, sf))


def deviation_rows(spark: SparkSession, sf: str, zone: str = "UTC") -> DataFrame:
    rows = deduped(spark, sf).withColumn("actual", F.date_trunc("SECOND", "ingested_at"))
    return deviation.deviations(rows, t.stop_times(spark, sf), zone, "actual")


def raw_entities(spark: SparkSession, sf: str) -> DataFrame:
    """Events as decoded entities, with positions off the globe, missing ids and odd timestamps among them."""
    null = "CAST(NULL AS STRING)"
    return t.read(spark, sf, "events").selectExpr(
        "CAST(event_id AS STRING) AS id",
        f"""named_struct('trip', named_struct('trip_id', CAST(user_id AS STRING), 'route_id', concat('R', user_id % 10), 'schedule_relationship', {null}),
        'vehicle', named_struct('id', CASE WHEN event_id % 13 = 0 THEN '' WHEN event_id % 17 <> 0 THEN CAST(user_id AS STRING) END, 'label', {null}),
        'position', named_struct('latitude', CASE WHEN event_id % 19 <> 0 THEN value - 10 END, 'longitude', -71D, 'bearing', 450D, 'speed', CAST(NULL AS DOUBLE)),
        'current_stop_sequence', CAST(NULL AS INT), 'stop_id', {null}, 'current_status', event_type,
        'timestamp', CASE event_id % 23 WHEN 0 THEN '' WHEN 1 THEN 'abc' WHEN 2 THEN NULL ELSE CAST(unix_seconds(CAST(ts AS TIMESTAMP)) AS STRING) END) AS vehicle""",
    )


ENTITIES = """entities AS (SELECT event_id, CASE WHEN event_id % 19 <> 0 THEN value - 10 END AS lat, CASE WHEN event_id % 13 = 0 THEN '' WHEN event_id % 17 <> 0 THEN CAST(user_id AS VARCHAR) END AS vid,
  CASE event_id % 23 WHEN 0 THEN 0 WHEN 1 THEN NULL WHEN 2 THEN NULL ELSE floor(epoch(ts)) END AS sec, 'R' || (user_id % 10) AS route_id, event_type FROM events),
checked AS (SELECT *, CASE WHEN lat IS NULL OR NOT lat BETWEEN -90 AND 90 THEN 'position' WHEN coalesce(vid, '') = '' THEN 'vehicle_id' WHEN sec IS NULL THEN 'timestamp' END AS reason FROM entities)"""


# validation and messages


@query("SELECT vid AS vehicle_id, route_id, lat, CAST(-71 AS DOUBLE) AS lon, make_timestamp(CAST(sec AS BIGINT) * 1000000) AS \"timestamp\", CAST(450 AS DOUBLE) AS bearing, event_type AS current_status FROM checked WHERE reason IS NULL", ENTITIES)
def p_valid_telemetry(spark: SparkSession, sf: str) -> DataFrame:
    rows = messages.flattened(validate.telemetry(raw_entities(spark, sf)))
    return rows.select("vehicle_id", "route_id", "lat", "lon", F.col("timestamp").cast(NTZ).alias("timestamp"), "bearing", "current_status")


@query("SELECT CAST(count(*) AS BIGINT) AS n FROM entities WHERE lat BETWEEN -90 AND 90", ENTITIES)
def p_valid_position(spark: SparkSession, sf: str) -> DataFrame:
    place = F.col("vehicle.position")
    return raw_entities(spark, sf).filter(validate.valid_position(place["latitude"], place["longitude"])).agg(F.count("*").alias("n"))


@query("SELECT coalesce(reason, 'valid') AS reason, CAST(count(*) AS BIGINT) AS n FROM checked GROUP BY 1", ENTITIES)
def p_reject_reasons(spark: SparkSession, sf: str) -> DataFrame:
    return validate.checked(raw_entities(spark, sf)).groupBy(F.coalesce("reject_reason", F.lit("valid")).alias("reason")).agg(F.count("*").alias("n"))


@query("SELECT CAST(count(*) AS BIGINT) AS entities, CAST(count(reason) AS BIGINT) AS skipped FROM checked", ENTITIES)
def p_skipped(spark: SparkSession, sf: str) -> DataFrame:
    return validate.skipped(raw_entities(spark, sf))


ISO = "strftime(make_timestamp((CAST(sec AS BIGINT) + {}) * 1000000), '%Y-%m-%dT%H:%M:%S.%gZ')"


@query(
    f"""SELECT vid AS key, 'mbta' AS agency_id, vid AS vehicle_id, route_id, event_type AS current_status, {ISO.format(0)} AS "timestamp", {ISO.format(5)} AS ingested_at, true AS null_is_written
  FROM checked WHERE reason IS NULL""",
    ENTITIES,
)
def p_envelope(spark: SparkSession, sf: str) -> DataFrame:
    """The messages' keys and the fields in their JSON, taken in five seconds after the report."""
    out = messages.envelope(validate.telemetry(raw_entities(spark, sf)), ingested_at=F.expr("timestamp + INTERVAL 5 SECONDS"))
    fields = ("agency_id", "vehicle_id", "route_id", "current_status", "timestamp", "ingested_at")
    return out.select("key", *[F.get_json_object("value", f"$.{c}").alias(c) for c in fields], F.contains("value", F.lit('"stop_id":null')).alias("null_is_written"))


@query("SELECT vid AS vehicle_id, CAST(-71 AS DOUBLE) AS lon, lat, make_timestamp(CAST(sec AS BIGINT) * 1000000) AS \"timestamp\" FROM checked WHERE reason IS NULL", ENTITIES)
def s_json_flatten(spark: SparkSession, sf: str) -> DataFrame:
    """To messages and back: the JSON round trip keeps every value."""
    out = messages.pings(messages.envelope(validate.telemetry(raw_entities(spark, sf))))
    return out.select("vehicle_id", "lon", "lat", F.col("timestamp").cast(NTZ).alias("timestamp"))


NULL_STOPS = """SELECT p.route_id, s.zone, CAST(count(*) AS BIGINT) AS n, CAST(count(p.stop_id) AS BIGINT) AS with_stop FROM {pings} p LEFT JOIN {stops} s ON p.stop_id = s.stop_id
  WHERE p.route_id IN (SELECT explode(:routes)) GROUP BY p.route_id, s.zone"""


@query("SELECT p.route_id, s.zone, CAST(count(*) AS BIGINT) AS n, CAST(count(p.stop_id) AS BIGINT) AS with_stop FROM pings p LEFT JOIN stops s ON p.stop_id = s.stop_id WHERE p.route_id IN ('R1', 'R4', 'R9') GROUP BY p.route_id, s.zone", t.PINGS, t.STOPS)
def s_sql_over_frames(spark: SparkSession, sf: str) -> DataFrame:
    """SQL text over frames in scope, with a list as a parameter."""
    return spark.sql(NULL_STOPS, {"routes": F.array(*map(F.lit, ("R1", "R4", "R9")))}, pings=t.pings(spark, sf), stops=t.stops(spark, sf))


# dedup and gaps


@query('SELECT vehicle_id, "timestamp", ingested_at, event_id, current_status, stop_id FROM deduped', *BASE)
def w_dedup_latest(spark: SparkSession, sf: str) -> DataFrame:
    return deduped(spark, sf).select("vehicle_id", F.col("timestamp").cast(NTZ).alias("timestamp"), F.col("ingested_at").cast(NTZ).alias("ingested_at"), "event_id", "current_status", "stop_id")


@query("SELECT CAST(sum(n) AS BIGINT) AS n_rows, CAST(count(*) AS BIGINT) AS n_deduped, round(100 * (1 - count(*) / sum(n)), 6) AS pct_removed FROM (SELECT count(*) AS n FROM pings GROUP BY vehicle_id, \"timestamp\")", t.PINGS)
def a_dedup_report(spark: SparkSession, sf: str) -> DataFrame:
    return quality.dedup_report(t.pings(spark, sf))


@query(f'SELECT vehicle_id, "timestamp", prev_timestamp, prev_status, g AS {GAP} FROM gaps', *GAPS)
def w_lag_gaps(spark: SparkSession, sf: str) -> DataFrame:
    return gap_rows(spark, sf).select("vehicle_id", F.col("timestamp").cast(NTZ).alias("timestamp"), F.col("prev_timestamp").cast(NTZ).alias("prev_timestamp"), "prev_status", GAP)


DESCRIBE = "CAST(count({0}) AS BIGINT) AS count, round(avg({0}), 6) AS mean, round(stddev_samp({0}), 6) AS std, round(CAST(min({0}) AS DOUBLE), 6) AS min, round(quantile_cont(CAST({0} AS DOUBLE), 0.25), 6) AS p25, round(quantile_cont(CAST({0} AS DOUBLE), 0.5), 6) AS p50, round(quantile_cont(CAST({0} AS DOUBLE), 0.75), 6) AS p75, round(CAST(max({0}) AS DOUBLE), 6) AS max"


def quantile_sql(column: str, qs: tuple[float, ...]) -> str:
    return ", ".join(f"round(quantile_cont(CAST({column} AS DOUBLE), {q}), 6) AS {stats.quantile_name(q)}" for q in qs)


GAP_QS, LATENCY_QS, DEVIATION_QS = (0.5, 0.75, 0.9, 0.95, 0.99), (0.5, 0.9, 0.95, 0.99), (0.01, 0.05, 0.25, 0.5, 0.75, 0.95, 0.99)


@query(f"SELECT {DESCRIBE.format('g')} FROM gaps", *GAPS)
def a_gap_describe(spark: SparkSession, sf: str) -> DataFrame:
    return stats.described(gap_rows(spark, sf), GAP)


@query(f"SELECT {quantile_sql('g', GAP_QS)} FROM gaps", *GAPS)
def a_gap_quantiles(spark: SparkSession, sf: str) -> DataFrame:
    return stats.quantiles(gap_rows(spark, sf), GAP, GAP_QS)


@query("SELECT round(quantile_cont(CAST(g AS DOUBLE), 0.99), 6) AS gap_quantile, round(quantile_cont(CAST(g AS DOUBLE), 0.99) + 15, 6) AS threshold_seconds FROM gaps", *GAPS)
def q_silent_threshold(spark: SparkSession, sf: str) -> DataFrame:
    return quality.threshold(gap_rows(spark, sf))


# displacement and dwells


@query('SELECT vehicle_id, "timestamp", round(d, 6) AS displacement_meters, likely_dwell FROM dwell', *GAPS, t.DWELL)
def f_displacement(spark: SparkSession, sf: str) -> DataFrame:
    return dwell_rows(spark, sf).select("vehicle_id", F.col("timestamp").cast(NTZ).alias("timestamp"), F.round("displacement_meters", 6).alias("displacement_meters"), "likely_dwell")


@query("SELECT CAST(count(*) FILTER (likely_dwell) AS BIGINT) AS n_dwell, CAST(count(*) AS BIGINT) AS n_gaps, round(100 * count(*) FILTER (likely_dwell) / count(*), 6) AS pct_dwell FROM dwell", *GAPS, t.DWELL)
def p_dwell_split(spark: SparkSession, sf: str) -> DataFrame:
    return quality.dwell_share(dwell_rows(spark, sf))


@query(f"SELECT likely_dwell, {DESCRIBE.format('g')} FROM dwell GROUP BY likely_dwell", *GAPS, t.DWELL)
def a_dwell_movement_describe(spark: SparkSession, sf: str) -> DataFrame:
    return stats.described(dwell_rows(spark, sf), GAP, ["likely_dwell"])


@query(f"SELECT {quantile_sql('g', GAP_QS)} FROM moves", *MOVES)
def a_movement_quantiles(spark: SparkSession, sf: str) -> DataFrame:
    return stats.quantiles(moves(spark, sf), GAP, GAP_QS)


# outages

CUTS = " UNION ALL ".join(f"SELECT CAST({q} AS DOUBLE) AS q, quantile_cont(CAST(g AS DOUBLE), {q}) AS c FROM moves" for q in quality.SWEEP)
SWEEP = f"""cuts AS ({CUTS}),
large AS (SELECT q, c, vehicle_id, date_trunc('hour', prev_timestamp) AS m FROM moves JOIN cuts ON g >= c),
by_minute AS (SELECT q, c, m, count(*) AS n, count(DISTINCT vehicle_id) AS v FROM large GROUP BY q, c, m)"""
SWEPT = "SELECT q AS cutoff_quantile, round(first(c), 1) AS cutoff_seconds, CAST(sum(n) AS BIGINT) AS n_large_gaps, CAST(max(v) AS BIGINT) AS max_vehicles_in_one_minute, first(m ORDER BY v DESC, m) AS busiest_minute FROM by_minute GROUP BY q"


@query(SWEPT, *MOVES, SWEEP)
def a_cluster_sweep(spark: SparkSession, sf: str) -> DataFrame:
    return quality.cluster_sweep(moves(spark, sf), bucket=BUCKET).withColumn("busiest_minute", F.col("busiest_minute").cast(NTZ))


@query(f"SELECT * FROM ({SWEPT}) WHERE max_vehicles_in_one_minute >= 5", *MOVES, SWEEP)
def p_cluster_flags(spark: SparkSession, sf: str) -> DataFrame:
    return quality.flagged(quality.cluster_sweep(moves(spark, sf), bucket=BUCKET)).withColumn("busiest_minute", F.col("busiest_minute").cast(NTZ))


@query(SWEPT, *MOVES, SWEEP)
def u_sweep_union(spark: SparkSession, sf: str) -> DataFrame:
    """The sweep as a union of one plan for each quantile, over gaps that are written once."""
    rows = checkpointed(moves(spark, sf).select("vehicle_id", "prev_timestamp", GAP))
    out = None
    for q in quality.SWEEP:
        one = quality.cluster_sweep(rows, [q], BUCKET)
        out = one if out is None else out.unionByName(one)
    return out.withColumn("busiest_minute", F.col("busiest_minute").cast(NTZ))


WINDOW = """suspect AS (SELECT m, count(DISTINCT vehicle_id) AS v FROM (SELECT vehicle_id, date_trunc('hour', prev_timestamp) AS m FROM moves WHERE g >= (SELECT quantile_cont(CAST(g AS DOUBLE), 0.9) FROM moves)) GROUP BY m HAVING count(DISTINCT vehicle_id) >= 5),
outage AS (SELECT min(m) AS s, max(m) AS e, count(*) AS n FROM suspect)"""


@query("SELECT m AS minute, CAST(v AS BIGINT) AS n_vehicles FROM suspect", *MOVES, WINDOW)
def p_suspect_minutes(spark: SparkSession, sf: str) -> DataFrame:
    return quality.suspect_minutes(moves(spark, sf), 0.9, bucket=BUCKET).select(F.col("minute").cast(NTZ).alias("minute"), "n_vehicles")


@query("SELECT s AS window_start, e AS window_end, CAST(n AS BIGINT) AS n_minutes, coalesce((epoch(e) - epoch(s)) / 3600 + 1 = n, false) AS is_contiguous FROM outage", *MOVES, WINDOW)
def w_outage_window(spark: SparkSession, sf: str) -> DataFrame:
    out = quality.outage_window(moves(spark, sf), 0.9, bucket=BUCKET)
    return out.withColumns({c: F.col(c).cast(NTZ) for c in ("window_start", "window_end")})


CLEAN = "clean AS (SELECT moves.* FROM moves, outage WHERE s IS NULL OR NOT coalesce(prev_timestamp BETWEEN s AND e + INTERVAL 1 HOUR, false))"


@query("SELECT CAST(count(*) AS BIGINT) AS n, CAST(sum(g) AS BIGINT) AS total FROM clean", *MOVES, WINDOW, CLEAN)
def p_outside_outage(spark: SparkSession, sf: str) -> DataFrame:
    rows = moves(spark, sf)
    out = quality.outside_outage(rows, quality.outage_window(rows, 0.9, bucket=BUCKET), BUCKET)
    return out.agg(F.count("*").alias("n"), F.sum(GAP).alias("total"))


@query("SELECT round(quantile_cont(CAST(g AS DOUBLE), 0.99), 6) AS gap_quantile, round(quantile_cont(CAST(g AS DOUBLE), 0.99) + 15, 6) AS threshold_seconds FROM clean", *MOVES, WINDOW.replace("0.9)", "0.99)"), CLEAN)
def q_clean_threshold(spark: SparkSession, sf: str) -> DataFrame:
    return quality.clean_threshold(moves(spark, sf), bucket=BUCKET)


# side analyses


@query("SELECT route_id, CAST(count(stop_id) AS BIGINT) AS reported, CAST(count(*) AS BIGINT) AS total, round(1.0 - count(stop_id) / count(*), 6) AS pct_missing FROM deduped GROUP BY route_id", *BASE)
def a_null_rate_by_route(spark: SparkSession, sf: str) -> DataFrame:
    return quality.null_rate_by_route(deduped(spark, sf))


@query("SELECT current_status, CAST(count(*) AS BIGINT) AS n, round(100 * count(*) / sum(count(*)) OVER (), 6) AS pct FROM deduped WHERE current_status IS NOT NULL GROUP BY current_status", *BASE)
def a_status_distribution(spark: SparkSession, sf: str) -> DataFrame:
    return quality.status_distribution(deduped(spark, sf))


LATENCY = "(epoch_us(ingested_at) - epoch_us(\"timestamp\")) / CAST(1000000 AS DOUBLE)"


@query(f"SELECT {quantile_sql(LATENCY, LATENCY_QS)} FROM deduped", *BASE)
def a_latency(spark: SparkSession, sf: str) -> DataFrame:
    return stats.quantiles(quality.with_latency(deduped(spark, sf)), "latency_seconds", LATENCY_QS)


@query(f"SELECT {DESCRIBE.format('x')} FROM (SELECT {LATENCY} AS x FROM deduped)", *BASE)
def a_latency_describe(spark: SparkSession, sf: str) -> DataFrame:
    return stats.described(quality.with_latency(deduped(spark, sf)), "latency_seconds")


# stops


@query('SELECT d.vehicle_id, d."timestamp", d.stop_id, s.stop_name, s.zone FROM deduped d LEFT JOIN stops s ON d.stop_id = s.stop_id', *BASE, t.STOPS)
def j_stop_enrichment(spark: SparkSession, sf: str) -> DataFrame:
    return stops.enriched(deduped(spark, sf), t.stops(spark, sf)).select("vehicle_id", F.col("timestamp").cast(NTZ).alias("timestamp"), "stop_id", "stop_name", "zone")


@query("SELECT CAST(count(stop_id) AS BIGINT) AS n_with_stop, CAST(count(*) AS BIGINT) AS n_pings, round(100 * count(stop_id) / count(*), 6) AS pct_with_stop FROM deduped", *BASE)
def a_stop_coverage(spark: SparkSession, sf: str) -> DataFrame:
    return stops.coverage(deduped(spark, sf))


STEPS = 'steps AS (SELECT *, CASE WHEN trip_id IS NOT NULL THEN current_stop_sequence - lag(current_stop_sequence) OVER (PARTITION BY vehicle_id, trip_id ORDER BY "timestamp") END AS diff FROM deduped WHERE current_stop_sequence IS NOT NULL)'


@query("SELECT CAST(count(*) FILTER (diff < 0) AS BIGINT) AS n_backwards, CAST(count(*) AS BIGINT) AS n_observations, round(100 * count(*) FILTER (diff < 0) / count(*), 6) AS pct_backwards FROM steps", *BASE, STEPS)
def w_sequence_backwards(spark: SparkSession, sf: str) -> DataFrame:
    return stops.backward_share(stops.sequence_steps(deduped(spark, sf)))


@query('SELECT vehicle_id, trip_id, "timestamp", current_stop_sequence, CAST(diff AS INT) AS seq_diff FROM steps WHERE diff < 0', *BASE, STEPS)
def p_backward_steps(spark: SparkSession, sf: str) -> DataFrame:
    rows = stops.sequence_steps(deduped(spark, sf)).filter("seq_diff < 0")
    return rows.select("vehicle_id", "trip_id", F.col("timestamp").cast(NTZ).alias("timestamp"), "current_stop_sequence", "seq_diff")


NULL_TRIPS = "null_trips AS (SELECT DISTINCT trip_id FROM deduped WHERE stop_id IS NULL AND trip_id IS NOT NULL)"


@query("SELECT trip_id FROM null_trips", *BASE, NULL_TRIPS)
def a_distinct_trips(spark: SparkSession, sf: str) -> DataFrame:
    return stops.null_stop_trips(deduped(spark, sf))


@query(
    "SELECT CAST(count(*) AS BIGINT) AS total_null_stop_trips, CAST(count(s.trip_id) AS BIGINT) AS resolvable_in_static_schedule, round(100 * count(s.trip_id) / count(*), 6) AS pct_resolvable FROM null_trips n LEFT JOIN (SELECT DISTINCT trip_id FROM stop_times) s ON n.trip_id = s.trip_id",
    *BASE, NULL_TRIPS, t.STOP_TIMES,
)
def j_fallback_feasibility(spark: SparkSession, sf: str) -> DataFrame:
    return stops.feasibility(stops.null_stop_trips(deduped(spark, sf)), t.stop_times(spark, sf))


@query("SELECT CAST(count(*) AS BIGINT) AS n FROM deduped WHERE NOT coalesce(route_id LIKE 'R9%', false)", *BASE)
def p_without_shuttles(spark: SparkSession, sf: str) -> DataFrame:
    return stops.without_shuttles(deduped(spark, sf), "R9").agg(F.count("*").alias("n"))


# schedule deviation

CROSSERS = "SELECT DISTINCT trip_id FROM stop_times WHERE (CAST(split_part(arrival_time, ':', 1) AS INT) >= 24 OR CAST(split_part(departure_time, ':', 1) AS INT) >= 24) AND trip_id IN (SELECT trip_id FROM deduped)"


@query(CROSSERS, *BASE, t.STOP_TIMES)
def p_midnight_crossers(spark: SparkSession, sf: str) -> DataFrame:
    return deviation.midnight_crossers(t.stop_times(spark, sf), deduped(spark, sf))


@query(f"SELECT CAST(count(*) AS BIGINT) AS n_trips FROM ({CROSSERS})", *BASE, t.STOP_TIMES)
def a_midnight_trip_count(spark: SparkSession, sf: str) -> DataFrame:
    return deviation.midnight_crossers(t.stop_times(spark, sf), deduped(spark, sf)).agg(F.count_distinct("trip_id").alias("n_trips"))


@query(
    "SELECT trip_id, stop_sequence, departure_time, CAST(split_part(departure_time, ':', 1) AS BIGINT) * 3600 + CAST(split_part(departure_time, ':', 2) AS BIGINT) * 60 + CAST(split_part(departure_time, ':', 3) AS BIGINT) AS offset_seconds FROM stop_times",
    t.STOP_TIMES,
)
def f_gtfs_offset(spark: SparkSession, sf: str) -> DataFrame:
    return t.stop_times(spark, sf).select("trip_id", "stop_sequence", "departure_time", schedule_offset(F.col("departure_time")).alias("offset_seconds"))


@query("SELECT vehicle_id, trip_id, event_id, current_stop_sequence, arrival_time, departure_time FROM matched", *DEVIATIONS)
def j_schedule_join(spark: SparkSession, sf: str) -> DataFrame:
    return deviation.scheduled(deduped(spark, sf), t.stop_times(spark, sf)).select("vehicle_id", "trip_id", "event_id", "current_stop_sequence", "arrival_time", "departure_time")


@query("SELECT vehicle_id, event_id, scheduled_time_str, scheduled_datetime FROM deviations", *DEVIATIONS)
def f_nearest_anchor(spark: SparkSession, sf: str) -> DataFrame:
    return deviation_rows(spark, sf).select("vehicle_id", "event_id", "scheduled_time_str", F.col("scheduled_datetime").cast(NTZ).alias("scheduled_datetime"))


ZONED = """zoned AS (SELECT *, CAST(epoch(timezone('America/New_York', date_trunc('day', timezone('America/New_York', timezone('UTC', actual))))) AS BIGINT) + same - CAST(epoch(date_trunc('day', actual)) AS BIGINT) AS here FROM anchored),
zoned_at AS (SELECT *, CASE WHEN abs(a - here) <= abs(a - here + 86400) AND abs(a - here) <= abs(a - here - 86400) THEN here WHEN abs(a - here + 86400) <= abs(a - here - 86400) THEN here - 86400 ELSE here + 86400 END AS sched FROM zoned)"""


@query("SELECT vehicle_id, event_id, scheduled_time_str, make_timestamp(sched * 1000000) AS scheduled_datetime FROM zoned_at", *DEVIATIONS, ZONED)
def f_nearest_anchor_local(spark: SparkSession, sf: str) -> DataFrame:
    """With the service day of the agency's zone."""
    rows = deviation_rows(spark, sf, deviation.AGENCY_ZONE)
    return rows.select("vehicle_id", "event_id", "scheduled_time_str", F.col("scheduled_datetime").cast(NTZ).alias("scheduled_datetime"))


@query("SELECT vehicle_id, trip_id, event_id, current_status, scheduled_time_str, CAST(dev AS DOUBLE) AS deviation_seconds FROM deviations", *DEVIATIONS)
def q_deviation(spark: SparkSession, sf: str) -> DataFrame:
    return deviation_rows(spark, sf).select("vehicle_id", "trip_id", "event_id", "current_status", "scheduled_time_str", "deviation_seconds")


@query(f"SELECT {DESCRIBE.format('dev')} FROM deviations", *DEVIATIONS)
def a_deviation_describe(spark: SparkSession, sf: str) -> DataFrame:
    return stats.described(deviation_rows(spark, sf), "deviation_seconds")


@query(f"SELECT {quantile_sql('dev', DEVIATION_QS)} FROM deviations", *DEVIATIONS)
def a_deviation_quantiles(spark: SparkSession, sf: str) -> DataFrame:
    return stats.quantiles(deviation_rows(spark, sf), "deviation_seconds", DEVIATION_QS)


@query(f"SELECT current_status, {DESCRIBE.format('dev')} FROM deviations WHERE current_status IS NOT NULL GROUP BY current_status", *DEVIATIONS)
def a_deviation_by_status(spark: SparkSession, sf: str) -> DataFrame:
    return stats.described(deviation_rows(spark, sf).filter("current_status IS NOT NULL"), "deviation_seconds", ["current_status"])


@query("SELECT CAST(count(*) FILTER (abs(dev) > 7200) AS BIGINT) AS n_extreme, CAST(count(*) AS BIGINT) AS n_deviations, round(100 * count(*) FILTER (abs(dev) > 7200) / count(*), 6) AS pct_extreme FROM deviations", *DEVIATIONS)
def p_extreme_deviation(spark: SparkSession, sf: str) -> DataFrame:
    return deviation.extreme_share(deviation_rows(spark, sf))


@query('SELECT vehicle_id, "timestamp", g AS real_update_gap_seconds FROM gaps ORDER BY g DESC, vehicle_id, "timestamp" LIMIT 20', *GAPS)
def o_topk_gaps(spark: SparkSession, sf: str) -> DataFrame:
    """A report of the longest gaps; the limit is the feature."""
    rows = gap_rows(spark, sf).select("vehicle_id", F.col("timestamp").cast(NTZ).alias("timestamp"), GAP)
    return rows.orderBy(F.desc_nulls_last(GAP), F.asc_nulls_last("vehicle_id"), F.asc_nulls_last("timestamp")).limit(20)


# streaming operators over stored rows


@query('SELECT vehicle_id, "timestamp", ingested_at, event_id, current_status FROM deduped', *BASE)
def r_watermark_dedup(spark: SparkSession, sf: str) -> DataFrame:
    """The streaming dedup over stored rows."""
    rows = live.deduplicated(t.pings(spark, sf), ["event_id"])
    return rows.select("vehicle_id", F.col("timestamp").cast(NTZ).alias("timestamp"), F.col("ingested_at").cast(NTZ).alias("ingested_at"), "event_id", "current_status")


@query('SELECT vehicle_id, max("timestamp") AS last_seen FROM pings GROUP BY vehicle_id HAVING epoch((SELECT max("timestamp") FROM pings)) - epoch(max("timestamp")) > 77', t.PINGS)
def r_silent_vehicles(spark: SparkSession, sf: str) -> DataFrame:
    return live.silent_batch(t.pings(spark, sf)).select("vehicle_id", F.col("last_seen").cast(NTZ).alias("last_seen"))


@query("SELECT date_trunc('hour', prev_timestamp) AS minute, CAST(count(DISTINCT vehicle_id) AS BIGINT) AS n_vehicles FROM gaps WHERE g >= 77 GROUP BY 1", *GAPS)
def r_tumbling_outage(spark: SparkSession, sf: str) -> DataFrame:
    """The first operator of the streaming outage detection over stored rows, by hour."""
    return live.distinct_vehicles(gap_rows(spark, sf), 60).select(F.col("minute").cast(NTZ).alias("minute"), "n_vehicles")


# extensions


@query(
    """SELECT vehicle_id, route_id, event_id, CAST(dev AS DOUBLE) AS deviation_seconds, coalesce(current_status = 'STOPPED_AT', false) AS is_definitive FROM
  (SELECT *, row_number() OVER (PARTITION BY vehicle_id ORDER BY "timestamp" DESC, scheduled_datetime DESC, dev DESC, trip_id DESC) AS n FROM deviations) WHERE n = 1""",
    *DEVIATIONS,
)
def n_live_delays(spark: SparkSession, sf: str) -> DataFrame:
    return extensions.live_delays(deviation_rows(spark, sf)).select("vehicle_id", "route_id", "event_id", "deviation_seconds", "is_definitive")


@query(
    """SELECT a.route_id, a.bucket, a.vehicle_id AS vehicle_a, b.vehicle_id AS vehicle_b, round(sqrt(pow((b.lat - a.lat) * 111320, 2) + pow((b.lon - a.lon) * 111320 * cos(radians((a.lat + b.lat) / 2)), 2)), 3) AS meters
  FROM spots a JOIN spots b ON a.route_id = b.route_id AND a.bucket = b.bucket AND a.vehicle_id < b.vehicle_id
  WHERE sqrt(pow((b.lat - a.lat) * 111320, 2) + pow((b.lon - a.lon) * 111320 * cos(radians((a.lat + b.lat) / 2)), 2)) <= 40""",
    *BASE,
    """spots AS (SELECT route_id, bucket, vehicle_id, lat, lon FROM (SELECT *, row_number() OVER (PARTITION BY route_id, bucket, vehicle_id ORDER BY "timestamp" DESC, lat DESC, lon DESC) AS n FROM
  (SELECT *, CAST(floor(epoch("timestamp")) AS BIGINT) // 3600 AS bucket FROM deduped)) WHERE n = 1)""",
)
def n_bunching(spark: SparkSession, sf: str) -> DataFrame:
    return extensions.bunching(deduped(spark, sf), meters=40, seconds=3600)


@query(
    """SELECT route_id, date_trunc('day', actual) AS window_start, CAST(count(*) AS BIGINT) AS n, round(avg(dev), 6) AS mean_seconds, round(quantile_cont(CAST(dev AS DOUBLE), 0.5), 6) AS median_seconds,
  round(avg(CASE WHEN abs(dev) <= 300 THEN 1.0 ELSE 0.0 END), 6) AS on_time FROM deviations GROUP BY 1, 2""",
    *DEVIATIONS,
)
def n_route_reliability(spark: SparkSession, sf: str) -> DataFrame:
    out = extensions.route_reliability(deviation_rows(spark, sf), "actual", length="1 day", slide="1 day")
    return out.withColumn("window_start", F.col("window_start").cast(NTZ))


@query(
    """SELECT CAST(floor(lat / 0.001) AS BIGINT) AS cell_lat, CAST(floor(lon / 0.001) AS BIGINT) AS cell_lon, CAST(count(*) AS BIGINT) AS n, CAST(count(*) FILTER (d / g < 2) AS BIGINT) AS n_slow, round(avg(d / g), 9) AS mean_mps
  FROM moves WHERE g > 0 GROUP BY 1, 2""",
    *MOVES,
)
def n_slow_cells(spark: SparkSession, sf: str) -> DataFrame:
    return extensions.slow_cells(dwell_rows(spark, sf))


@query(
    """SELECT vehicle_id, min(prev_timestamp) AS began, max("timestamp") AS ended, CAST(sum(g) AS BIGINT) AS dwell_seconds FROM
  (SELECT *, sum(CASE WHEN likely_dwell THEN 0 ELSE 1 END) OVER (PARTITION BY vehicle_id ORDER BY "timestamp") AS run FROM dwell) WHERE likely_dwell GROUP BY vehicle_id, run""",
    *GAPS, t.DWELL,
)
def n_terminal_dwell(spark: SparkSession, sf: str) -> DataFrame:
    out = extensions.terminal_dwell(dwell_rows(spark, sf))
    return out.withColumns({c: F.col(c).cast(NTZ) for c in ("began", "ended")})


SCHEDULE = "schedule AS (SELECT trip_id, stop_sequence, coalesce(min(arrival_time), min(departure_time)) AS at_time FROM stop_times GROUP BY ALL)"
OFFSET = "CAST(split_part(at_time, ':', 1) AS BIGINT) * 3600 + CAST(split_part(at_time, ':', 2) AS BIGINT) * 60 + CAST(split_part(at_time, ':', 3) AS BIGINT)"


def nearest_sql(table: str, at: str, out: str) -> str:
    """The rows of `table` with `out`: epoch seconds of the scheduled instant nearest the UTC instant `at`, for an at_time that may be NULL."""
    same = f"CAST(epoch(date_trunc('day', {at})) AS BIGINT) + {OFFSET}"
    gap = f"epoch({at}) - same"
    return f"""(SELECT * EXCLUDE (same), CASE WHEN abs({gap}) <= abs({gap} + 86400) AND abs({gap}) <= abs({gap} - 86400) THEN same
    WHEN abs({gap} + 86400) <= abs({gap} - 86400) THEN same - 86400 ELSE same + 86400 END AS {out} FROM (SELECT *, {same} AS same FROM {table}))"""


UPDATES = f"""updates AS (SELECT CAST(user_id * 100 + day(ts) AS VARCHAR) AS trip_id, date_trunc('second', ts) AS made_at, 1 + k % 7 AS stop_sequence, k * 37 % 900 - 300 AS delay,
  CASE event_id % 7 WHEN 0 THEN 'NO_DATA' WHEN 1 THEN 'SKIPPED' ELSE 'SCHEDULED' END AS relationship, CASE WHEN event_id % 2 = 0 THEN 60 END AS trip_delay
  FROM (SELECT *, CAST(regexp_extract(props, '([0-9]+)', 1) AS INT) AS k FROM events) WHERE event_id % 3 = 0),
own AS (SELECT * FROM updates QUALIFY row_number() OVER (PARTITION BY trip_id, made_at, stop_sequence ORDER BY delay DESC, relationship DESC) = 1),
stops_told AS (SELECT m.trip_id, m.made_at, m.trip_delay, s.stop_sequence, s.at_time, o.relationship, CASE WHEN o.relationship = 'NO_DATA' THEN 1000000 ELSE o.delay END AS told
  FROM (SELECT trip_id, made_at, max(trip_delay) AS trip_delay FROM updates GROUP BY ALL) m JOIN schedule s USING (trip_id) LEFT JOIN own o ON m.trip_id = o.trip_id AND m.made_at = o.made_at AND s.stop_sequence = o.stop_sequence),
carried AS (SELECT *, nullif(coalesce(last_value(told IGNORE NULLS) OVER (PARTITION BY trip_id, made_at ORDER BY stop_sequence ROWS UNBOUNDED PRECEDING), trip_delay), 1000000) AS d FROM {nearest_sql("stops_told", "made_at", "scheduled")}),
predicted AS (SELECT trip_id, stop_sequence, made_at, scheduled + d AS predicted FROM carried WHERE coalesce(relationship, '') <> 'SKIPPED' AND scheduled + d IS NOT NULL),
stopped AS (SELECT trip_id, current_stop_sequence AS stop_sequence, min(date_trunc('second', ingested_at)) AS actual FROM deduped WHERE trip_id IS NOT NULL AND current_status = 'STOPPED_AT' GROUP BY trip_id, current_stop_sequence, CAST(ingested_at AS DATE)),
judged AS (SELECT s.trip_id, s.stop_sequence, actual, made_at, predicted, CAST(epoch(actual) - predicted AS BIGINT) AS error_seconds, CAST(floor((epoch(actual) - epoch(made_at)) / 60) AS BIGINT) AS minutes_ahead
  FROM stopped s ASOF JOIN predicted p ON s.trip_id = p.trip_id AND s.stop_sequence = p.stop_sequence AND s.actual >= p.made_at WHERE epoch(actual) - epoch(made_at) <= 86400)"""
JUDGED = (*BASE, t.STOP_TIMES, SCHEDULE, UPDATES)


def judged_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Events are sparse, so predictions count for a day."""
    predicted = predictions.predicted_arrivals(t.stop_updates(spark, sf), t.schedule(spark, sf), "UTC")
    seen = deduped(spark, sf).withColumn("actual", F.date_trunc("SECOND", "ingested_at"))
    return predictions.judged(predicted, predictions.arrivals(seen, "UTC", "actual"), 86_400)


@query("SELECT trip_id, stop_sequence, make_timestamp(made_at_us) AS made_at, predicted FROM (SELECT trip_id, stop_sequence, epoch_us(made_at) AS made_at_us, predicted FROM predicted)", *JUDGED)
def n_predicted_arrivals(spark: SparkSession, sf: str) -> DataFrame:
    """What each trip update says about all stops of its trip; predicted is in epoch seconds."""
    rows = predictions.predicted_arrivals(t.stop_updates(spark, sf), t.schedule(spark, sf), "UTC")
    return rows.select("trip_id", "stop_sequence", F.col("made_at").cast(NTZ).alias("made_at"), F.unix_seconds("predicted_time").alias("predicted"))


@query("SELECT trip_id, stop_sequence, actual AS actual_time, made_at, error_seconds FROM judged", *JUDGED)
def n_prediction_judged(spark: SparkSession, sf: str) -> DataFrame:
    """Each arrival with the last prediction before it."""
    return judged_rows(spark, sf).select("trip_id", "stop_sequence", F.col("actual_time").cast(NTZ).alias("actual_time"), F.col("made_at").cast(NTZ).alias("made_at"), "error_seconds")


@query("SELECT minutes_ahead, CAST(count(*) AS BIGINT) AS n, round(avg(error_seconds), 6) AS mean_error, round(avg(abs(error_seconds)), 6) AS mean_abs_error FROM judged GROUP BY minutes_ahead", *JUDGED)
def n_prediction_error(spark: SparkSession, sf: str) -> DataFrame:
    return predictions.prediction_error(judged_rows(spark, sf))


BUNCHED = f"""trips AS (SELECT CAST(o_orderkey AS VARCHAR) AS trip_id, 'R' || (o_custkey % 10) AS route_id, o_orderkey % 2 AS direction_id FROM orders),
seen AS (SELECT *, date_trunc('second', ingested_at) AS passed_at FROM deduped),
passes AS (SELECT trip_id, vehicle_id, stop_id, current_stop_sequence AS stop_sequence, CAST(passed_at AS DATE) AS day, passed_at, lat, lon FROM seen WHERE trip_id IS NOT NULL AND stop_id IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY trip_id, vehicle_id, stop_id, current_stop_sequence, CAST(passed_at AS DATE) ORDER BY passed_at, lat, lon) = 1),
timed AS (SELECT p.*, t.route_id, t.direction_id, s.at_time FROM passes p JOIN trips t USING (trip_id) LEFT JOIN schedule s ON p.trip_id = s.trip_id AND p.stop_sequence = s.stop_sequence),
led AS (SELECT *, lag(vehicle_id) OVER w AS leader, epoch(passed_at) - epoch(lag(passed_at) OVER w) AS headway, scheduled - lag(scheduled) OVER w AS planned FROM {nearest_sql("timed", "passed_at", "scheduled")}
  WINDOW w AS (PARTITION BY route_id, direction_id, stop_id, day ORDER BY passed_at, vehicle_id, trip_id, stop_sequence)),
places AS (SELECT vehicle_id, passed_at AS seen_at, lat AS lat0, lon AS lon0 FROM seen QUALIFY row_number() OVER (PARTITION BY vehicle_id, passed_at ORDER BY lat DESC, lon DESC) = 1),
near AS (SELECT l.*, sqrt(pow((lat - lat0) * 111320, 2) + pow((lon - lon0) * 111320 * cos(radians((lat + lat0) / 2)), 2)) AS meters
  FROM (SELECT * FROM led WHERE leader <> vehicle_id AND planned > 0 AND headway / planned < 0.5) l ASOF JOIN places p ON l.leader = p.vehicle_id AND l.passed_at >= p.seen_at WHERE epoch(passed_at) - epoch(seen_at) <= 86400)"""


@query(
    """SELECT route_id, CAST(direction_id AS INT) AS direction_id, stop_id, leader, vehicle_id AS follower, passed_at, CAST(headway AS BIGINT) AS headway_seconds, CAST(planned AS BIGINT) AS scheduled_headway_seconds,
  round(headway / planned, 6) AS headway_ratio, round(meters, 3) AS meters FROM near WHERE meters <= 60""",
    *BASE, t.STOP_TIMES, SCHEDULE, BUNCHED,
)
def n_bunching_headway(spark: SparkSession, sf: str) -> DataFrame:
    """Consecutive vehicles of a route and direction within 60 m, at less than half the scheduled headway. Events are sparse, so positions count for a day."""
    rows = deduped(spark, sf).withColumn("actual", F.date_trunc("SECOND", "ingested_at"))
    out = bunching.bunched(rows, t.trips(spark, sf), t.schedule(spark, sf), 60, 0.5, "UTC", "actual", 86_400)
    return out.withColumns({"passed_at": F.col("passed_at").cast(NTZ), "headway_ratio": F.round("headway_ratio", 6), "meters": F.round("meters", 3)})


CLUSTERS = """cells AS (SELECT CAST(floor(lat / 0.00005) AS BIGINT) AS cell_lat, CAST(floor(lon / 0.00005) AS BIGINT) AS cell_lon, count(*) AS n, count(*) FILTER (d / g < 0.0015) AS n_slow, round(avg(d / g), 9) AS mean_mps FROM moves WHERE g > 0 GROUP BY 1, 2),
dense AS (SELECT * FROM cells WHERE n_slow >= 3 AND n_slow >= 0.5 * n),
reached(a, o, a2, o2) AS (SELECT cell_lat, cell_lon, cell_lat, cell_lon FROM dense UNION SELECT r.a, r.o, d.cell_lat, d.cell_lon FROM reached r JOIN dense d ON d.cell_lat - r.a2 BETWEEN -1 AND 1 AND d.cell_lon - r.o2 BETWEEN -1 AND 1),
clusters AS (SELECT a AS cell_lat, o AS cell_lon, min(a2) AS cluster_lat, arg_min(o2, a2 * 2147483648 + o2) AS cluster_lon FROM reached GROUP BY ALL)"""


def slow_dense(spark: SparkSession, sf: str) -> DataFrame:
    return extensions.slow_cells(dwell_rows(spark, sf), cell_degrees=0.00005, slow_mps=0.0015)


@query("SELECT cell_lat, cell_lon, cluster_lat, cluster_lon FROM clusters", *MOVES, CLUSTERS)
def n_slow_clusters(spark: SparkSession, sf: str) -> DataFrame:
    """Each dense slow cell with its cluster."""
    return bottlenecks.clusters(bottlenecks.dense_cells(slow_dense(spark, sf))).select("cell_lat", "cell_lon", "cluster_lat", "cluster_lon")


@query("SELECT cluster_lat, cluster_lon, CAST(count(*) AS BIGINT) AS n_cells, CAST(sum(n) AS BIGINT) AS n, CAST(sum(n_slow) AS BIGINT) AS n_slow, round(sum(mean_mps * n) / sum(n), 6) AS mean_mps FROM clusters JOIN dense USING (cell_lat, cell_lon) GROUP BY ALL", *MOVES, CLUSTERS)
def n_bottlenecks(spark: SparkSession, sf: str) -> DataFrame:
    return bottlenecks.bottlenecks(slow_dense(spark, sf))


@query('SELECT vehicle_id, "timestamp", lat, lon FROM deduped WHERE lat BETWEEN 42.00001 AND 42.00006 AND lon BETWEEN -71.0008 AND -71.0002', *BASE)
def k_box_query(spark: SparkSession, sf: str) -> DataFrame:
    """Positions in a box, from a store that two batches were written to, one of them twice."""
    rows, path = deduped(spark, sf), new_folder(spark, "store")
    for batch_id, half in ((0, "event_id % 2 = 0"), (1, "event_id % 2 <> 0"), (0, "event_id % 2 = 0")):
        store.save(rows.filter(half), path, batch_id)
    out = store.in_box(store.stored(spark, path), 42.00001, -71.0008, 42.00006, -71.0002)
    return out.select("vehicle_id", F.col("timestamp").cast(NTZ).alias("timestamp"), "lat", "lon")


@query("SELECT route_id, date_trunc('week', actual) AS week, CAST(count(*) AS BIGINT) AS n, round(avg(dev), 6) AS mean_seconds, CAST(count(*) FILTER (abs(dev) > 300) AS BIGINT) AS n_off FROM deviations GROUP BY 1, 2", *DEVIATIONS)
def n_weekly_report(spark: SparkSession, sf: str) -> DataFrame:
    out = extensions.weekly_report(deviation_rows(spark, sf), "actual")
    return out.withColumn("week", F.col("week").cast(NTZ))
