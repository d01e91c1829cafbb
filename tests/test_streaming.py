"""Streams over file logs: equal to the batch operators, also after restarts and replays."""

import logging
import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tramline.operators import deviation, quality
from tramline.sources import messages, store
from tramline.sources.capture import capture, captured
from tramline.streaming import ingest, live
from tramline.streaming.schedule import Schedule, deviation_stream
from tramline.streaming.supervised import CycleLog, log_to, supervised

T0 = datetime(2026, 1, 5, 8)
FAR = datetime(2027, 1, 1)
PINGS = "vehicle_id string, timestamp timestamp, ingested_at timestamp, current_status string, n int"


def add(spark, path, rows, schema):
    """One more file of a log."""
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(path))


def drained(stream_to, folder):
    """Runs a query until it has read all there is."""
    query = stream_to.option("checkpointLocation", str(folder)).trigger(availableNow=True).start()
    query.awaitTermination(180)
    return query


def source(spark, path, schema, files=1):
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files).parquet(str(path))


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=str)


def shuffled_pings(n=300, seed=3):
    rng, out = random.Random(seed), []
    for k in range(n):
        t = T0 + timedelta(seconds=15 * rng.randrange(60))
        out.append((f"v{rng.randrange(6)}", t, None if rng.random() < 0.1 else t + timedelta(seconds=rng.randrange(90)), rng.choice(["STOPPED_AT", None]), k))
    rng.shuffle(out)
    return out


def test_dedup_keeps_the_latest_and_survives_a_restart(spark, tmp_path):
    rows = shuffled_pings()
    log, out, check = tmp_path / "log", tmp_path / "out", tmp_path / "check"

    def go():
        drained(live.deduplicated(source(spark, log, PINGS), ["n"]).writeStream.format("parquet").option("path", str(out)), check)

    for k in range(0, 150, 50):
        add(spark, log, rows[k : k + 50], PINGS)
    go()
    for k in range(150, 300, 50):  # the same query again, from its checkpoint
        add(spark, log, rows[k : k + 50], PINGS)
    go()
    assert not out.exists() or spark.read.schema(PINGS).parquet(str(out)).count() == 0  # the watermark holds all back
    add(spark, log, [("end", FAR, FAR, None, -1)], PINGS)
    go()
    expected = rows_of(quality.latest(spark.createDataFrame(rows, PINGS), ["n"]))
    assert len(expected) < 300
    assert rows_of(spark.read.parquet(str(out))) == expected
    # a better duplicate of what was given out is late, and refused
    v, t, _, _, _ = rows[0]
    add(spark, log, [(v, t, FAR, "late", 999)], PINGS)
    go()
    assert rows_of(spark.read.parquet(str(out))) == expected


def test_gaps_of_a_shuffled_log_equal_the_batch(spark, tmp_path):
    live.use_rocksdb(spark)
    rows = shuffled_pings(200, 9)
    log, out = tmp_path / "log", tmp_path / "out"
    for k in range(0, 200, 70):
        add(spark, log, rows[k : k + 70], PINGS)
    add(spark, log, [("end", FAR, FAR, None, -1)], PINGS)
    drained(live.deduplicated_gaps(source(spark, log, PINGS), ["n"]).writeStream.format("parquet").option("path", str(out)), tmp_path / "check")
    df = spark.createDataFrame(rows, PINGS).withColumns({"lat": F.lit(0.0), "lon": F.lit(0.0)})
    expected = quality.gaps(quality.latest(df, ["n"])).select("vehicle_id", "prev_timestamp", "timestamp", quality.GAP)
    got = spark.read.parquet(str(out)).filter("vehicle_id <> 'end'")
    assert rows_of(got) == rows_of(expected) and got.count() > 100


GAPS = "vehicle_id string, prev_timestamp timestamp, real_update_gap_seconds long"


def test_outages_equal_the_batch(spark, tmp_path):
    live.use_rocksdb(spark)
    rng, rows = random.Random(5), []
    for minute in (3, 4, 5, 9, 11, 12):  # suspect: five vehicles or more, some of them twice
        rows += [(f"v{v}", T0 + timedelta(minutes=minute, seconds=rng.randrange(60)), 100 + rng.randrange(50)) for v in list(range(5 + minute % 3)) * 2]
    for minute in (0, 6, 7, 10, 13):  # many gaps of few vehicles
        rows += [(f"v{v % 4}", T0 + timedelta(minutes=minute, seconds=v), 200) for v in range(12)]
    rows += [(f"w{v}", T0 + timedelta(minutes=8), 5) for v in range(40)]  # short gaps
    rng.shuffle(rows)
    log, out, check = tmp_path / "log", tmp_path / "out", tmp_path / "check"

    def go():
        drained(live.outages(source(spark, log, GAPS), lateness="20 minutes").writeStream.format("parquet").option("path", str(out)), check)

    half = len(rows) // 2
    add(spark, log, rows[:half], GAPS)
    go()
    add(spark, log, rows[half:], GAPS)
    add(spark, log, [("end", FAR, 0)], GAPS)  # a short gap moves the watermark on
    go()
    runs = sorted(map(tuple, spark.read.parquet(str(out)).collect()))
    at = [T0 + timedelta(minutes=m) for m in (3, 5, 9, 11, 12)]
    assert [r[:3] for r in runs] == [(at[0], at[1], 3), (at[2], at[2], 1), (at[3], at[4], 2)]
    large = spark.createDataFrame(rows, GAPS).filter("real_update_gap_seconds >= 77")
    whole = quality.outage_window(large, q=0.0).first()
    assert (min(r[0] for r in runs), max(r[1] for r in runs), sum(r[2] for r in runs)) == (whole["window_start"], whole["window_end"], whole["n_minutes"])
    assert (len(runs) == 1) == whole["is_contiguous"]


def test_distinct_vehicles_are_counted_once(spark):
    rows = [("a", T0, 100), ("a", T0 + timedelta(seconds=30), 100), ("b", T0, 100), ("c", T0, 10), ("a", T0 + timedelta(minutes=1), 100)]
    got = rows_of(live.distinct_vehicles(spark.createDataFrame(rows, GAPS)).select("minute", "n_vehicles"))
    assert got == [(T0, 2), (T0 + timedelta(minutes=1), 1)]


STOPPED = "vehicle_id string, trip_id string, stop_id string, current_stop_sequence int, timestamp timestamp, current_status string"
TIMES = "trip_id,stop_id,stop_sequence,arrival_time,departure_time\n"


def stopped(n, minutes):
    return (f"v{n}", "t1", "s", 1, T0 + timedelta(minutes=minutes), "STOPPED_AT")


def test_deviation_meets_the_schedule_of_its_time(spark, tmp_path):
    log, out, check, folder = tmp_path / "log", tmp_path / "out", tmp_path / "check", str(tmp_path / "schedule")
    feed = tmp_path / "stop_times.txt"
    feed.write_text(TIMES + "t1,s,1,08:00:00,\n")

    def go(clock=lambda: 0.0):
        schedule = Schedule(spark, str(feed), folder, clock=clock)
        drained(deviation_stream(source(spark, log, STOPPED), schedule, str(out), "UTC"), check)
        return schedule

    add(spark, log, [stopped(1, 1)], STOPPED)
    go()
    got = spark.read.parquet(str(out))
    batch = deviation.deviations(spark.read.parquet(str(log)), Schedule(spark, str(feed), folder).load(spark, str(feed)), "UTC")
    assert rows_of(got.select(*batch.columns)) == rows_of(batch)  # unchanged: as the batch
    feed.write_text(TIMES + "t1,s,1,08:05:00,\n")
    add(spark, log, [stopped(2, 2)], STOPPED)
    go()
    found = {r["vehicle_id"]: (r["deviation_seconds"], r["schedule_version"]) for r in spark.read.parquet(str(out)).collect()}
    assert (found["v1"][0], found["v2"][0]) == (60.0, -180.0)  # the earlier row has the old schedule
    assert found["v1"][1] != found["v2"][1]


def test_schedule_is_looked_at_in_its_time(spark, tmp_path):
    feed, now = tmp_path / "stop_times.txt", [0.0]
    feed.write_text(TIMES + "t1,s,1,08:00:00,\n")
    schedule = Schedule(spark, str(feed), str(tmp_path / "versions"), every=100, clock=lambda: now[0])
    first = schedule.of_batch(0)
    feed.write_text(TIMES + "t1,s,1,08:05:00,\nt2,s,1,08:05:00,\n")
    now[0] = 99.0
    assert schedule.of_batch(1) == first
    now[0] = 100.0
    second = schedule.of_batch(2)
    assert second != first and schedule.rows(second).count() == 2 and schedule.rows(first).count() == 1
    again = Schedule(spark, str(feed), str(tmp_path / "versions"))  # after a restart: batch 1 is repeated with what it had
    assert again.of_batch(1) == first and again.of_batch(3) == second
    feed.write_text(TIMES + "t2,s,1,08:05:00,\nt1,s,1,08:05:00,\n")  # other bytes, the same rows
    now[0] = 300.0
    assert schedule.of_batch(4) == second


MESSAGES = "key string, value string"


@pytest.fixture
def message_log(spark, tmp_path):
    for k in range(5):
        add(spark, tmp_path / "messages", [(str(i), "x") for i in range(10 * k, 10 * k + 10)], MESSAGES)
    return tmp_path / "messages"


def test_capture_ends_by_messages(spark, tmp_path, message_log):
    got = capture(source(spark, message_log, MESSAGES), str(tmp_path / "a"), messages=25, seconds=600)
    assert (got.messages, got.ended_by) == (25, "messages")
    assert captured(spark, str(tmp_path / "a"), MESSAGES).distinct().count() == 25


def test_capture_ends_by_time(spark, tmp_path, message_log):
    now = iter([0.0, 10.0, 20.0, *[31.0] * 10_000])  # at the start, and as each batch begins
    got = capture(source(spark, message_log, MESSAGES), str(tmp_path / "a"), messages=1000, seconds=30, clock=lambda: next(now))
    assert got.ended_by == "time" and got.messages <= 20 and got.messages == captured(spark, str(tmp_path / "a"), MESSAGES).count()


def test_capture_ends_with_the_log(spark, tmp_path, message_log):
    got = capture(source(spark, message_log, MESSAGES), str(tmp_path / "a"), seconds=600)
    assert (got.messages, got.ended_by, len(got.batches)) == (50, "end", 5)
    # nothing was committed: another capture begins anew, and reads all
    assert capture(source(spark, message_log, MESSAGES), str(tmp_path / "b"), seconds=600).messages == 50


def test_capture_raises_the_sources_error(spark, tmp_path, message_log):
    broken = source(spark, message_log, MESSAGES).select(F.raise_error(F.lit("broken")).alias("key"))
    with pytest.raises(Exception, match="broken"):
        capture(broken, str(tmp_path / "a"), seconds=600)


# the partitioned store

PLACES = "vehicle_id string, timestamp timestamp, lat double, lon double"


def random_places(n=400, seed=1):
    rng = random.Random(seed)
    odd = [("null", T0, None, 1.0), ("off", T0, 91.0, 0.0), ("pole", T0, 90.0, 180.0), ("corner", T0, -90.0, -180.0), ("nan", T0, float("nan"), 0.0), ("when", None, 1.0, 1.0)]
    return [*odd, *((f"v{k}", T0 + timedelta(days=k % 3), rng.uniform(-90, 90), rng.uniform(-180, 180)) for k in range(n))]


@pytest.mark.parametrize("box", [(-10, -20, 30, 40), (42.0, -71.5, 42.5, -71.0), (50, 170, 90, -170), (-90, -180, 90, 180), (1.0, 1.0, 1.0, 1.0)])
def test_boxes(spark, box):
    rows = random_places()
    south, west, north, east = box
    inside = [v for v, _, lat, lon in rows if lat is not None and south <= lat <= north and (west <= lon <= east if west <= east else lon >= west or lon <= east)]
    got = store.in_box(store.with_cells(spark.createDataFrame(rows, PLACES)), *box)
    assert sorted(r["vehicle_id"] for r in got.collect()) == sorted(inside)


def test_replayed_batch_adds_nothing(spark, tmp_path):
    rows, path = spark.createDataFrame(random_places(), PLACES), str(tmp_path / "store")
    for batch_id in (0, 1, 0):
        store.save(rows.filter(F.pmod(F.xxhash64("vehicle_id"), F.lit(2)) == batch_id), path, batch_id)
    assert store.stored(spark, path).count() == rows.count()
    plan = store.in_box(store.stored(spark, path), 42.0, -71.5, 42.5, -71.0)._jdf.queryExecution().executedPlan().toString()
    filters = plan[plan.index("PartitionFilters") :].split("PushedFilters")[0]
    assert "cell" in filters and "GreaterThanOrEqual(lat" in plan
    assert store.stored(spark, path).select("batch", "day", "cell").distinct().count() > 100


def test_stream_to_store(spark, tmp_path):
    log, path = tmp_path / "log", str(tmp_path / "store")
    for k in range(2):
        add(spark, log, random_places(50, k), PLACES)
    drained(store.save_stream(source(spark, log, PLACES), path), tmp_path / "check")
    assert sorted(r[0] for r in store.stored(spark, path).groupBy("batch").count().collect()) == [0, 1]
    assert store.stored(spark, path).count() == 112


def test_cells_cover_the_globe():
    assert store.cell_ranges(-90, -180, 90, 180) == [(0, (1 << 2 * store.CELL_BITS) - 1)]
    assert len(store.cell_ranges(42.0, -71.5, 42.5, -71.0)) < 12


# supervision


def failing_stream(spark, log, out, check, fails):
    """Fails while `fails` says so; a batch number in it fails at that batch."""

    def each(batch, batch_id):
        if fails and (fails[0] is True or fails[0] == batch_id):
            fails.pop(0)
            raise RuntimeError("broken")
        batch.write.mode("overwrite").parquet(f"{out}/{batch_id}")

    return lambda: source(spark, log, MESSAGES).writeStream.foreachBatch(each).option("checkpointLocation", str(check)).trigger(availableNow=True).start()


def test_supervised_query_starts_again(spark, tmp_path, message_log, caplog):
    waits = []
    with caplog.at_level(logging.WARNING):
        keeper = supervised(failing_stream(spark, message_log, tmp_path / "out", tmp_path / "check", [True] * 6), waits.append)
    assert keeper.failures == 0 and waits == [15, 15, 15, 15, 15, 30]  # as polling does
    assert sum(r.levelno == logging.CRITICAL for r in caplog.records) == 2
    assert sum(spark.read.parquet(str(p)).count() for p in (tmp_path / "out").iterdir()) == 50  # nothing lost, nothing twice


def test_progress_ends_a_row_of_failures(spark, tmp_path, message_log):
    waits = []
    keeper = supervised(failing_stream(spark, message_log, tmp_path / "out", tmp_path / "check", [0, 0, 2, 2]), waits.append, turns=3)
    assert keeper.failures == 1 and waits == [15, 15]  # the third start got to batch 2, so its failure is the first in a row


def test_cycles_are_logged(spark, tmp_path, message_log):
    path = tmp_path / "feed.log"
    logger = logging.getLogger("tramline.test_cycles")
    log_to(str(path), logger)
    listener = CycleLog(logger=logger)
    spark.streams.addListener(listener)
    try:
        rows = source(spark, message_log, MESSAGES).withColumn("reject_reason", F.when(F.col("key").cast("int") % 10 == 0, "position"))
        drained(live.counted(rows).writeStream.format("noop"), tmp_path / "check")
        for _ in range(50):
            if path.read_text().count("published 9, skipped 1") == 5:
                break
            import time

            time.sleep(0.2)
    finally:
        spark.streams.removeListener(listener)
    text = path.read_text()
    assert text.count("published 9, skipped 1") == 5 and " ms" in text and "INFO" in text


# ingestion from end to end


def polled(url):
    from test_ingestion import vehicle

    from tramline.sources.feed import encode

    good = [vehicle(vid=f"v{k}", ts=str(1_700_000_000 + k)) for k in range(5)]
    bad = [vehicle(lat=95.0), vehicle(vid=""), {"id": "trip", "trip_update": {"trip": {"trip_id": "t"}, "stop_time_update": []}}]
    return encode({"header": {"gtfs_realtime_version": "2.0"}, "entity": good + bad})


def test_ingestion_job(spark, tmp_path):
    """Polls, decodes, validates and appends to the log, from which the pings are read back."""
    log = str(tmp_path / "log")
    rows = ingest.feed_messages(ingest.snapshots(spark, fetcher="test_streaming:polled"))
    query = ingest.scheduled(ingest.to_log(rows, log), str(tmp_path / "check"), 1).start()
    try:
        for _ in range(60):
            if any(p.observedMetrics and p.numInputRows for p in query.recentProgress):
                break
            query.awaitTermination(1)
    finally:
        query.stop()
    cycle = next(p.observedMetrics["cycle"] for p in query.recentProgress if p.observedMetrics and p.numInputRows)
    assert (cycle["published"], cycle["skipped"]) == (5, 3)
    pings = messages.pings(messages.from_log(spark, log))
    assert sorted({r["vehicle_id"] for r in pings.collect()}) == [f"v{k}" for k in range(5)]
    first = pings.filter("vehicle_id = 'v3'").first()
    assert (first["lat"], first["lon"], first["timestamp"]) == (pytest.approx(42.35, abs=1e-5), pytest.approx(-71.05, abs=1e-5), datetime(2023, 11, 14, 22, 13, 23))
    assert first["ingested_at"] > first["timestamp"] and {r["agency_id"] for r in messages.parsed(messages.from_log(spark, log)).collect()} == {"mbta"}
