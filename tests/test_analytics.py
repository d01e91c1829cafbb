from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tramline.functions.geo import displacement_meters
from tramline.functions.times import nearest_anchor, schedule_offset
from tramline.operators import deviation, quality, stops
from tramline.streaming import live

NY = "America/New_York"


@pytest.mark.parametrize(
    ("ping", "text", "expected"),
    [
        # UTC instants of the acceptance vectors
        ("2026-08-19 03:30:00", "25:10:00", "2026-08-19 05:10:00"),
        ("2026-08-19 05:05:00", "25:10:00", "2026-08-19 05:10:00"),
        ("2026-08-19 04:05:00", "23:55:00", "2026-08-19 03:55:00"),
        ("2026-08-19 16:00:00", "00:00:00", "2026-08-19 04:00:00"),
        ("2026-03-08 16:00:00", "08:00:00", "2026-03-08 13:00:00"),
        ("2026-03-09 04:30:00", "24:20:00", "2026-03-09 04:20:00"),
        ("2026-11-01 17:00:00", "08:00:00", "2026-11-01 12:00:00"),
        ("2026-11-02 05:30:00", "24:20:00", "2026-11-02 05:20:00"),
    ],
)
def test_anchors(spark, ping, text, expected):
    df = spark.createDataFrame([(datetime.fromisoformat(ping), text)], "t timestamp, s string")
    assert str(df.select(nearest_anchor(F.col("t"), schedule_offset(F.col("s")), NY)).first()[0]) == expected


def test_schedule_offset(spark):
    df = spark.createDataFrame([("25:10:00",), (" 5:01:02",), ("x",), (None,), ("1:2",)], "s string")
    assert [r[0] for r in df.select(schedule_offset(F.col("s"))).collect()] == [90600, 18062, None, None, None]


def test_dwell_is_never_null(spark):
    rows = [(None, None, 0.0, 0.0, None, "STOPPED_AT"), (0.0, 0.0, 0.0, 0.0, "STOPPED_AT", None), (0.0, 0.0, 0.0, 0.0, None, None), (float("nan"), 0.0, 0.0, 0.0, "STOPPED_AT", None)]
    df = quality.with_dwell(spark.createDataFrame(rows, "prev_lat double, prev_lon double, lat double, lon double, prev_status string, current_status string"))
    assert [r["likely_dwell"] for r in df.collect()] == [False, True, False, False]
    assert quality.movement(df).count() + quality.dwells(df).count() == 4


def test_displacement(spark):
    df = spark.createDataFrame([(42.0, -71.0, 42.001, -71.0)], "a double, b double, c double, d double")
    assert abs(df.select(displacement_meters(*map(F.col, "abcd"))).first()[0] - 111.32) < 1e-6


def gap_frame(spark, rows):
    return spark.createDataFrame([(v, datetime.fromisoformat(t), g) for v, t, g in rows], "vehicle_id string, prev_timestamp timestamp, real_update_gap_seconds long")


def test_outage_window(spark):
    rows = [(str(v), f"2026-01-01 00:{m:02d}:10", 500) for m in (10, 11, 13) for v in range(5)] + [(str(v), "2026-01-01 01:00:00", 10) for v in range(50)]
    rows += [("edge", "2026-01-01 00:14:00", 20), ("after", "2026-01-01 00:14:01", 20)]
    df = gap_frame(spark, rows)
    w = quality.outage_window(df, 0.9)
    got = w.first()
    assert (str(got["window_start"]), str(got["window_end"]), got["n_minutes"], got["is_contiguous"]) == ("2026-01-01 00:10:00", "2026-01-01 00:13:00", 3, False)
    kept = {r["vehicle_id"] for r in quality.outside_outage(df, w).filter("real_update_gap_seconds = 20").collect()}
    assert kept == {"after"}
    calm = quality.outage_window(df, 0.9, vehicles=6)
    assert calm.first()["window_start"] is None and quality.outside_outage(df, calm).count() == df.count()
    sweep = {r["cutoff_quantile"]: r for r in quality.cluster_sweep(df).collect()}
    assert str(sweep[0.9]["busiest_minute"]) == "2026-01-01 00:10:00" and sweep[0.9]["max_vehicles_in_one_minute"] == 5
    assert quality.cluster_sweep(df.limit(0)).count() == 0


def test_latest_breaks_ties(spark):
    t = datetime(2026, 1, 1)
    df = spark.createDataFrame([("v", t, t, 1), ("v", t, t, 2), ("v", t, None, 3)], "vehicle_id string, timestamp timestamp, ingested_at timestamp, n int")
    assert [r["n"] for r in quality.latest(df, ["n"]).collect()] == [2]


def test_sequence_without_trip(spark):
    rows = [("v", None, 5, 1), ("v", None, 3, 2), ("v", "t", 5, 3), ("v", "t", 4, 4), ("v", "t", None, 5)]
    df = spark.createDataFrame(rows, "vehicle_id string, trip_id string, current_stop_sequence int, timestamp int")
    got = stops.backward_share(stops.sequence_steps(df)).first()
    assert (got["n_backwards"], got["n_observations"]) == (1, 4)


def test_shuttles_go_by_route_and_trip(spark):
    df = spark.createDataFrame([("Shuttle-Generic-Red", "1"), ("39", "BL-7"), ("39", "7"), (None, None)], "route_id string, trip_id string")
    assert stops.without_shuttles(df).count() == 3
    assert [tuple(r) for r in stops.without_shuttles(df, trip_prefix="BL").collect()] == [("39", "7"), (None, None)]


def test_deviation_fans_out_and_drops_null(spark):
    t = datetime(2026, 1, 1, 8)
    pings = spark.createDataFrame([("v", "t", "s", 1, t), ("v", "t", None, 1, t)], "vehicle_id string, trip_id string, stop_id string, current_stop_sequence int, timestamp timestamp")
    times = spark.createDataFrame([("t", 1, None, "08:00:30"), ("t", 1, "07:59:00", "08:00:00"), ("t", 1, None, None)], "trip_id string, stop_sequence int, arrival_time string, departure_time string")
    assert sorted(r["deviation_seconds"] for r in deviation.deviations(pings, times, "UTC").collect()) == [-30.0, 60.0]


def test_streams(spark, tmp_path):
    rows = [("a", 0), ("a", 10), ("a", 10), ("b", 5), ("b", 6000)]
    df = spark.createDataFrame([(v, datetime.fromtimestamp(1_700_000_000 + s)) for v, s in rows], "vehicle_id string, timestamp timestamp")
    df.coalesce(1).write.parquet(str(tmp_path / "in"))
    live.use_rocksdb(spark)

    def run(name, make):
        source = spark.readStream.schema(df.schema).parquet(str(tmp_path / "in"))
        q = make(source).writeStream.format("memory").queryName(name).option("checkpointLocation", str(tmp_path / name)).trigger(availableNow=True).start()
        q.awaitTermination(120)
        return spark.table(name).collect()

    # the best ping of a key is known once the watermark (6,000 s less 40 minutes) passes it
    assert sorted((r["vehicle_id"], r["timestamp"].timestamp() - 1_700_000_000) for r in run("deduplicated", live.deduplicated)) == [("a", 0), ("a", 10), ("b", 5)]
    assert [r["vehicle_id"] for r in run("silent", live.silent_vehicles)] == ["a"]
    assert {(r["vehicle_id"], r["real_update_gap_seconds"]) for r in run("gaps", live.stream_gaps)} == {("a", 10), ("a", 0), ("b", 5995)}
