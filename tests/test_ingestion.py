import logging
from datetime import datetime

import pytest

from tramline.operators import validate
from tramline.schemas import ENTITY, TELEMETRY
from tramline.sources import messages, polling, static
from tramline.sources.feed import FeedError, decode_feed, encode, entities


def vehicle(lat=42.35, lon=-71.05, vid="vehicle-1", trip="trip-1", ts="1700000000", **more):
    v = {"position": {"latitude": lat, "longitude": lon, **{k: more.pop(k) for k in ("bearing", "speed") if k in more}}, "timestamp": ts, **more}
    v |= {"vehicle": {"id": vid}} if vid is not None else {}
    v |= {"trip": {"trip_id": trip, "route_id": "route-1"}} if trip else {}
    return {"id": "e", "vehicle": v}


def frame(spark, *rows):
    def full(kind, value):
        return {f.name: full(f.dataType, value.get(f.name)) if hasattr(f.dataType, "fields") else value.get(f.name) for f in kind.fields} if value is not None else None

    return spark.createDataFrame([full(ENTITY, r) for r in rows], ENTITY)


def test_conversion(spark):
    row = validate.telemetry(frame(spark, vehicle())).first()
    assert row["location"]["coordinates"] == [-71.05, 42.35]
    assert row["timestamp"] == datetime(2023, 11, 14, 22, 13, 20)
    assert (row["speed"], row["bearing"], row["current_stop_sequence"], row["stop_id"], row["current_status"]) == (None,) * 5


@pytest.mark.parametrize(
    ("entity", "reason"),
    [
        ({"id": "e"}, "position"),
        (vehicle(lat=None), "position"),
        (vehicle(lat=float("nan")), "position"),
        (vehicle(lat=float("inf")), "position"),
        (vehicle(lat=95.0), "position"),
        (vehicle(lon=-200.0), "position"),
        (vehicle(lat=90.0, lon=-180.0), None),
        (vehicle(lat=0.0, lon=0.0), None),
        (vehicle(vid=None), "vehicle_id"),
        (vehicle(vid=""), "vehicle_id"),
        (vehicle(ts=None), "timestamp"),
        (vehicle(ts="abc"), "timestamp"),
        (vehicle(ts=""), None),
        (vehicle(trip=None), None),
        (vehicle(speed=-15.5, bearing=450.0), None),
        (vehicle(ts="0"), None),
        (vehicle(ts="-1000"), None),
        (vehicle(ts="4000000000"), None),
        (vehicle(ts="9e12"), None),
    ],
)
def test_rules(spark, entity, reason):
    rows = frame(spark, entity)
    assert validate.checked(rows).first()["reject_reason"] == reason
    assert validate.telemetry(rows).count() == (reason is None)
    assert validate.skipped(rows).first()["skipped"] == (reason is not None)


def test_feed_round_trip(spark):
    feed = {"header": {"gtfs_realtime_version": "2.0"}, "entity": [vehicle(lat=42.5, lon=-71.25, current_status="STOPPED_AT", current_stop_sequence=7), {"id": "alert"}]}
    data = encode(feed)
    got = decode_feed(data)
    assert got[0]["vehicle"]["timestamp"] == "1700000000" and got[0]["vehicle"]["current_status"] == "STOPPED_AT"
    assert "vehicle" not in got[1] and "current_status" not in decode_feed(encode({**feed, "entity": [vehicle()]}))[0]["vehicle"]
    rows = entities(spark.createDataFrame([(bytearray(data),), (bytearray(encode({"header": {"gtfs_realtime_version": "2.0"}, "entity": []})),)], "content binary"))
    assert [(r["id"], r["vehicle"] is None) for r in rows.collect()] == [("e", False), ("alert", True)]


@pytest.mark.parametrize("data", [b"", bytes.fromhex("ff00ff001234"), encode({"entity": []}), b"\x0a\x05ab"])
def test_feed_errors(data):
    with pytest.raises(FeedError):
        decode_feed(data)


def test_messages(spark, tmp_path):
    at = datetime(2026, 8, 7, 12, 34, 56, 789000)
    rows = spark.createDataFrame([("v", None, "r", ("Point", [-71.0, 42.0]), at, None, None, None, None, None)], TELEMETRY)
    from pyspark.sql import functions as F

    out = messages.envelope(rows, ingested_at=F.lit(datetime(2026, 8, 7, 12, 35, 0, 123000)))
    key, value = out.first()
    assert key == "v"
    for part in ('"agency_id":"mbta"', '"trip_id":null', '"timestamp":"2026-08-07T12:34:56.789Z"', '"ingested_at":"2026-08-07T12:35:00.123Z"', '"coordinates":[-71.0,42.0]'):
        assert part in value
    path = str(tmp_path / "log")
    assert messages.to_log(out.limit(0), path) == 0
    assert messages.to_log(out, path) == 1
    ping = messages.pings(messages.from_log(spark, path, 10)).first()
    assert (ping["lat"], ping["lon"], ping["timestamp"], ping["trip_id"]) == (42.0, -71.0, at, None)


def test_malformed_message(spark):
    with pytest.raises(Exception, match="(?i)malformed"):
        messages.parsed(spark.createDataFrame([("k", "{oops")], "key string, value string")).collect()


def test_static_tables(spark, tmp_path):
    (tmp_path / "stops.txt").write_text("﻿stop_id,stop_name,stop_lat,stop_lon\n007,North,42.1,x\n", encoding="utf-8")
    row = static.stops(spark, str(tmp_path / "stops.txt")).first()
    assert row["stop_id"] == "007" and row["stop_lat"] == 42.1 and row["stop_lon"] is None
    (tmp_path / "times.txt").write_text("trip_id,stop_id,stop_sequence,arrival_time,departure_time\n1,2,3,25:10:00,\n")
    times = static.stop_times(spark, str(tmp_path / "times.txt"))
    assert times.first()["arrival_time"] == "25:10:00" and static.version(times).first()["n_rows"] == 1


def test_backoff():
    assert [polling.wait_seconds(n) for n in (0, 4, 5, 6, 7, 20)] == [15, 15, 15, 30, 60, 300]
    assert polling.jittered(10, lambda: 0) == 8 and polling.jittered(10, lambda: 0.5) == 10


def run(results, caplog):
    it = iter(results)

    def poll():
        if not next(it):
            raise RuntimeError("no")

    s = polling.Supervisor(poll)
    with caplog.at_level(logging.WARNING):
        s.run(len(results), lambda _: None)
    return s.failures, *[sum(r.levelno == k for r in caplog.records) for k in (logging.ERROR, logging.CRITICAL, logging.WARNING)]


@pytest.mark.parametrize(
    ("results", "expected"), [([0] * 6, (6, 6, 2, 0)), ([0] * 5 + [1, 0], (1, 6, 1, 1)), ([0, 0, 1], (0, 2, 0, 0)), ([0] * 6 + [1], (0, 6, 2, 0))]
)
def test_supervisor(results, expected, caplog):
    assert run(results, caplog) == expected


def test_retries():
    calls, waits = [], []

    def failing(status):
        def call():
            calls.append(status)
            raise polling.HttpError(status)

        return call

    for status, n in ((503, 3), (429, 3), (None, 3), (404, 1)):
        calls.clear()
        with pytest.raises(polling.HttpError):
            polling.with_retry(failing(status), sleep=waits.append)
        assert len(calls) == n
    assert 0.8 <= waits[0] < 1.2 and 1.6 <= waits[1] < 2.4
    with pytest.raises(ValueError, match="empty"):
        polling.fetch("x", lambda url: b"")
    calls.clear()
    with pytest.raises(polling.HttpError):
        polling.connect_with_retry(failing(None), sleep=lambda _: None)
    assert len(calls) == 5


def fetched(url):
    return encode({"header": {"gtfs_realtime_version": "2.0"}, "entity": [vehicle()]})


def test_feed_stream(spark, tmp_path):
    spark.dataSource.register(polling.FeedSource)
    rows = spark.readStream.format("vehicle_feed").option("fetcher", "test_ingestion:fetched").load()
    q = rows.writeStream.format("memory").queryName("snapshots").option("checkpointLocation", str(tmp_path)).start()
    try:
        for _ in range(60):
            if spark.table("snapshots").count():
                break
            q.awaitTermination(1)
    finally:
        q.stop()
    assert entities(spark.table("snapshots").limit(1)).first()["vehicle"]["vehicle"]["id"] == "vehicle-1"


def test_environment(monkeypatch, tmp_path):
    from tramline.settings import Settings, load_env, required

    monkeypatch.setenv("KAFKA_BROKERS", "a:1, b:2")
    assert Settings.from_env().brokers == ["a:1", "b:2"]
    monkeypatch.setenv("KAFKA_BROKERS", "")
    with pytest.raises(ValueError, match="KAFKA_BROKERS"):
        required("KAFKA_BROKERS")
    load_env(str(tmp_path / "none"))


def test_producer(spark):
    options = messages.producer_options("a:1,b:2")
    assert options["kafka.bootstrap.servers"] == "a:1,b:2" and options["topic"] == "raw.vehicle-positions" and options["kafka.enable.idempotence"] == "true"
    with pytest.raises(Exception, match="(?i)kafka"):  # its connector isn't on the class path here
        messages.to_kafka(spark.createDataFrame([("k", "v")], "key string, value string"), "a:1")


def test_samples_are_saved(spark, tmp_path):
    rows = spark.createDataFrame([("a", 1), ("b", 2)], "vehicle_id string, n int")
    for _ in range(2):  # the second replaces the first
        messages.save_sample(rows, str(tmp_path / "sample"))
    assert sorted(map(tuple, spark.read.parquet(str(tmp_path / "sample")).collect())) == [("a", 1), ("b", 2)]


def test_trips(spark, tmp_path):
    (tmp_path / "trips.txt").write_text("route_id,trip_id,direction_id\n39,0071,1\n39,0072,\n")
    assert sorted(map(tuple, static.trips(spark, str(tmp_path / "trips.txt")).collect())) == [("0071", "39", 1), ("0072", "39", None)]


def test_decoder_against_garbage():
    good = encode({"header": {"gtfs_realtime_version": "2.0"}, "entity": [vehicle()]})
    assert len(decode_feed(good)) == 1
    for cut in range(1, len(good)):  # every shortened snapshot is an error or a message without its later parts
        try:
            assert len(decode_feed(good[:cut])) <= 1
        except FeedError:
            pass
    for bad in (b"", b"\x00", b"\xff" * 20, good + b"\x07", good[:-1] + b"\xff" * 11):
        with pytest.raises(FeedError):
            decode_feed(bad)


def test_decoder_reads_long_fields():
    long = {"header": {"gtfs_realtime_version": "2.0", "timestamp": str(2**64 - 1)}, "entity": [{"id": "é" * 300, **{k: v for k, v in vehicle().items() if k != "id"}} for _ in range(200)]}
    found = decode_feed(encode(long))
    assert len(found) == 200 and found[7]["id"] == "é" * 300
