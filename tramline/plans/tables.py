"""Transit views over the generic tables: events as pings, nation as stops, lineitem as stop times."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def utc(spark: SparkSession) -> SparkSession:
    """Instants are rendered and truncated in UTC, whatever the machine's zone."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return utc(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def pings(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = "CAST(regexp_extract(props, '([0-9]+)', 1) AS INT)"
    return read(spark, sf_dir, "events").selectExpr(
        "CAST(user_id AS STRING) AS vehicle_id",
        "CASE WHEN event_id % 11 <> 0 THEN CAST(user_id * 100 + day(ts) AS STRING) END AS trip_id",
        "concat('R', user_id % 10) AS route_id",
        "CAST(date_trunc('HOUR', ts) AS TIMESTAMP) AS timestamp",
        "CAST(ts AS TIMESTAMP) AS ingested_at",
        "CASE event_type WHEN 'click' THEN 'STOPPED_AT' WHEN 'view' THEN 'STOPPED_AT' WHEN 'purchase' THEN 'INCOMING_AT' WHEN 'signup' THEN 'IN_TRANSIT_TO' END AS current_status",
        f"CASE WHEN user_id % 10 <> 9 THEN CAST({k} % 30 AS STRING) END AS stop_id",
        f"1 + {k} % 7 AS current_stop_sequence",
        "42 + value / 1e6D AS lat",
        f"-71 - {k} / 1e5D AS lon",
        "event_id",
    )


def stops(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "nation").selectExpr("CAST(n_nationkey AS STRING) AS stop_id", "n_name AS stop_name", "n_regionkey AS zone")


def stop_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    time = "concat(lpad(CAST(int(l_quantity) % 28 AS STRING), 2, '0'), ':', lpad(CAST(l_partkey % 60 AS STRING), 2, '0'), ':', lpad(CAST(l_suppkey % 60 AS STRING), 2, '0'))"
    return read(spark, sf_dir, "lineitem").selectExpr(
        "CAST(l_orderkey AS STRING) AS trip_id", "l_linenumber AS stop_sequence", f"CASE WHEN l_linenumber <> 1 THEN {time} END AS arrival_time", f"{time} AS departure_time"
    )


def schedule(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stop times with each (trip_id, stop_sequence) once."""
    return stop_times(spark, sf_dir).groupBy("trip_id", "stop_sequence").agg(F.min("arrival_time").alias("arrival_time"), F.min("departure_time").alias("departure_time"))


def trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as trips, of ten routes and two directions."""
    return read(spark, sf_dir, "orders").selectExpr("CAST(o_orderkey AS STRING) AS trip_id", "concat('R', o_custkey % 10) AS route_id", "CAST(o_orderkey % 2 AS INT) AS direction_id").dropDuplicates(["trip_id"])


def stop_updates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Some events as the agency's trip updates, each for the delay at one stop; a few tell that there is no data."""
    k = "CAST(regexp_extract(props, '([0-9]+)', 1) AS INT)"
    return read(spark, sf_dir, "events").filter("event_id % 3 = 0").selectExpr(
        "CAST(user_id * 100 + day(ts) AS STRING) AS trip_id",
        "CAST(date_trunc('SECOND', ts) AS TIMESTAMP) AS made_at",
        f"1 + {k} % 7 AS stop_sequence",
        f"{k} * 37 % 900 - 300 AS delay",
        "CAST(NULL AS TIMESTAMP) AS predicted_time",
        "CASE event_id % 7 WHEN 0 THEN 'NO_DATA' WHEN 1 THEN 'SKIPPED' ELSE 'SCHEDULED' END AS relationship",
        "CASE WHEN event_id % 2 = 0 THEN 60 END AS trip_delay",
    )


#: The same in DuckDB, each a table expression that may use those before it.
PINGS = """pings AS (SELECT CAST(user_id AS VARCHAR) AS vehicle_id,
  CASE WHEN event_id % 11 <> 0 THEN CAST(user_id * 100 + day(ts) AS VARCHAR) END AS trip_id, 'R' || (user_id % 10) AS route_id,
  date_trunc('hour', ts) AS "timestamp", ts AS ingested_at,
  CASE event_type WHEN 'click' THEN 'STOPPED_AT' WHEN 'view' THEN 'STOPPED_AT' WHEN 'purchase' THEN 'INCOMING_AT' WHEN 'signup' THEN 'IN_TRANSIT_TO' END AS current_status,
  CASE WHEN user_id % 10 <> 9 THEN CAST(k % 30 AS VARCHAR) END AS stop_id, CAST(1 + k % 7 AS INT) AS current_stop_sequence,
  42 + value / CAST(1000000 AS DOUBLE) AS lat, -71 - k / CAST(100000 AS DOUBLE) AS lon, event_id
  FROM (SELECT *, CAST(regexp_extract(props, '([0-9]+)', 1) AS INT) AS k FROM events))"""
DEDUPED = """deduped AS (SELECT * EXCLUDE (n) FROM (SELECT *, row_number() OVER (PARTITION BY vehicle_id, "timestamp" ORDER BY ingested_at DESC NULLS LAST, event_id DESC) AS n FROM pings) WHERE n = 1)"""
LAGGED = """lagged AS (SELECT *, lag("timestamp") OVER w AS prev_timestamp, lag(lat) OVER w AS prev_lat, lag(lon) OVER w AS prev_lon, lag(current_status) OVER w AS prev_status
  FROM deduped WINDOW w AS (PARTITION BY vehicle_id ORDER BY "timestamp"))"""
GAPS = """gaps AS (SELECT *, CAST(floor(epoch("timestamp")) - floor(epoch(prev_timestamp)) AS BIGINT) AS g FROM lagged WHERE prev_timestamp IS NOT NULL)"""
DWELL = """dwell AS (SELECT *, d <= 50 AND (coalesce(current_status = 'STOPPED_AT', false) OR coalesce(prev_status = 'STOPPED_AT', false)) AS likely_dwell FROM
  (SELECT *, sqrt(pow((lat - prev_lat) * 111320, 2) + pow((lon - prev_lon) * 111320 * cos(radians((lat + prev_lat) / 2)), 2)) AS d FROM gaps))"""
MOVES = "moves AS (SELECT * FROM dwell WHERE NOT likely_dwell)"
STOPS = "stops AS (SELECT CAST(n_nationkey AS VARCHAR) AS stop_id, n_name AS stop_name, n_regionkey AS zone FROM nation)"
TIME = "lpad(CAST(CAST(floor(l_quantity) AS INT) % 28 AS VARCHAR), 2, '0') || ':' || lpad(CAST(l_partkey % 60 AS VARCHAR), 2, '0') || ':' || lpad(CAST(l_suppkey % 60 AS VARCHAR), 2, '0')"
STOP_TIMES = f"stop_times AS (SELECT CAST(l_orderkey AS VARCHAR) AS trip_id, l_linenumber AS stop_sequence, CASE WHEN l_linenumber <> 1 THEN {TIME} END AS arrival_time, {TIME} AS departure_time FROM lineitem)"
DEVIATIONS = """matched AS (SELECT d.*, s.arrival_time, s.departure_time, coalesce(s.arrival_time, s.departure_time) AS scheduled_time_str, date_trunc('second', d.ingested_at) AS actual
  FROM deduped d JOIN stop_times s ON d.trip_id = s.trip_id AND d.current_stop_sequence = s.stop_sequence WHERE d.stop_id IS NOT NULL),
anchored AS (SELECT *, CAST(epoch(actual) AS BIGINT) AS a, CAST(epoch(date_trunc('day', actual)) AS BIGINT) + CAST(split_part(scheduled_time_str, ':', 1) AS BIGINT) * 3600
  + CAST(split_part(scheduled_time_str, ':', 2) AS BIGINT) * 60 + CAST(split_part(scheduled_time_str, ':', 3) AS BIGINT) AS same FROM matched),
deviations AS (SELECT *, a - sched AS dev, make_timestamp(sched * 1000000) AS scheduled_datetime FROM
  (SELECT *, CASE WHEN abs(a - same) <= abs(a - same + 86400) AND abs(a - same) <= abs(a - same - 86400) THEN same WHEN abs(a - same + 86400) <= abs(a - same - 86400) THEN same - 86400 ELSE same + 86400 END AS sched FROM anchored))"""


def sql(select: str, *tables: str) -> str:
    return f"WITH RECURSIVE {', '.join(tables)}\n{select}"
