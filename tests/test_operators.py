"""Operators against plain versions: quantiles by rank, gaps by vehicle and day, as-of, predictions, bunching, clusters."""

import math
import random
from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from tramline.operators import bottlenecks, bunching, extensions, predictions, quality, stats
from tramline.operators.asof import latest_before
from tramline.sources.feed import FeedError, decode_feed, encode, entities

T0 = datetime(2026, 1, 5, 8)
QS = (0.0, 0.01, 0.25, 0.5, 0.9, 0.99, 1.0)


def at(seconds):
    return T0 + timedelta(seconds=seconds)


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=str)


def plain_quantiles(values):
    x = sorted((v for v in values if v is not None), key=lambda v: (math.isnan(v), v))
    if not x:
        return [None] * len(QS)
    out = []
    for q in QS:
        at = (len(x) - 1) * q
        lo, hi = x[math.floor(at)], x[math.ceil(at)]
        out.append(lo if lo == hi or (math.isnan(lo) and math.isnan(hi)) else lo + (hi - lo) * (at - math.floor(at)))
    return out


def alike(a, b):
    return all(x == y or (x is not None and y is not None and (math.isnan(x) and math.isnan(y) or math.isclose(x, y, rel_tol=1e-12))) for x, y in zip(a, b, strict=True))


VALUES = {
    "spread": [random.Random(1).gauss(0, 10) ** 5 for _ in range(400)],
    "close": [1.7e9 + random.Random(k).random() for k in range(300)],
    "few": [3.0, 3.0, 3.0, 1.0],
    "one": [7.5],
    "zeros": [0.0, -0.0, 0.0, -1e-300, 5e-324, None],
    "huge": [1e300, -1e300, 2.0, float("inf"), float("-inf"), float("inf"), None],
    "nan": [float("nan"), 1.0, float("nan"), 2.0],
    "powers": [2.0**k for k in range(-20, 20)] + [-(2.0**k) for k in range(-20, 20)],
}


def test_quantiles_of_groups(spark):
    groups = {**VALUES, None: [1.0, 2.0, None], "nothing": [None, None]}
    df = spark.createDataFrame([(g, v) for g, values in groups.items() for v in values], "g string, x double").repartition(3)
    got = {r["g"]: r["_q"] for r in stats.quantiles_by_rank(df, "x", QS, ["g"]).collect()}
    assert got.keys() == groups.keys()
    for g, values in groups.items():
        assert alike(got[g], plain_quantiles(values)), g


@pytest.mark.parametrize("case", [*VALUES, "empty", "nulls"])
def test_quantiles_of_all_rows(spark, case):
    values = {**VALUES, "empty": [], "nulls": [None, None]}[case]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    got = stats.quantiles_by_rank(df, "x", QS).collect()
    assert len(got) == 1 and alike(got[0]["_q"], plain_quantiles(values))


def test_quantiles_of_many_whole_numbers(spark):
    df = spark.range(0, 200_000, 1, 8).selectExpr("id * 7919 % 100003 AS x")
    expected = np.quantile(np.arange(200_000) * 7919 % 100_003, QS)
    assert stats.quantiles_by_rank(df, "x", QS).first()["_q"] == pytest.approx(expected.tolist(), rel=1e-12)


def test_no_buffer_of_all_values(spark):
    df = spark.range(100).selectExpr("id % 3 AS g", "CAST(id AS DOUBLE) AS x")
    for found in (stats.described(df, "x"), stats.described(df, "x", ["g"]), stats.quantiles(df, "x", QS)):
        assert "percentile" not in found._jdf.queryExecution().toString()
    assert stats.described(df, "x", ["g"]).count() == 3
    assert stats.described(df.limit(0), "x").first()["count"] == 0 and stats.described(df.limit(0), "x", ["g"]).count() == 0


# dedup and gaps by vehicle and day

PINGS = "vehicle_id string, timestamp timestamp, ingested_at timestamp, lat double, lon double, current_status string"


def plain_gaps(rows):
    best = {}
    for v, t, ing, lat, lon, status in rows:
        if (v, t) not in best or (ing is not None and (best[v, t][0] is None or ing > best[v, t][0])):
            best[v, t] = (ing, lat, lon, status)
    out, last = [], {}
    for v, t in sorted(((v, t) for v, t in best if t is not None), key=lambda k: (k[0] or "", k[1])):
        if v in last:
            p = best[v, last[v]]
            out.append((v, t, last[v], p[1], p[3], int((t - last[v]).total_seconds())))
        last[v] = t
    return sorted(out, key=str)


def busy_pings(n=600, seed=2):
    """One vehicle has most rows, over many days with some between them missing."""
    rng, out = random.Random(seed), []
    for k in range(n):
        v = "busy" if k % 5 else rng.choice(["a", "b", None])
        t = None if k % 97 == 0 else T0 + timedelta(days=rng.choice([0, 1, 2, 5, 6, 11]), seconds=60 * rng.randrange(1440))
        out.append((v, t, T0 + timedelta(seconds=k), rng.random(), rng.random(), rng.choice(["STOPPED_AT", "IN_TRANSIT_TO", None])))
    return out


@pytest.mark.parametrize("days", [True, False])
def test_gaps_over_midnight(spark, days):
    rows = busy_pings()
    df = spark.createDataFrame(rows, PINGS).repartition(5)
    ends = quality.day_ends(df) if days else None
    got = quality.gaps(quality.latest(df, days=days), ends)
    assert rows_of(got.select("vehicle_id", "timestamp", "prev_timestamp", "prev_lat", "prev_status", quality.GAP)) == plain_gaps(rows)
    assert not [c for c in got.columns if c.startswith("_")]


def test_one_vehicle_is_spread_over_tasks(spark):
    df = spark.createDataFrame([r for r in busy_pings() if r[0] == "busy"], PINGS)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        got = quality.gaps(quality.latest(df, days=True), quality.day_ends(df))
        assert len([n for n in got.rdd.mapPartitions(lambda it: [sum(1 for _ in it)]).collect() if n]) > 1
        plan = got._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert plan.count("REPARTITION_BY_COL") == 1 and "Exchange hashpartitioning(vehicle_id#" in plan
    assert plan.count("partial_max_by") == 1  # the days' ends are combined before their shuffle


# as-of


@pytest.mark.parametrize("within", [10, 60, 100_000])
def test_latest_before(spark, within):
    rng = random.Random(within)
    left = [(rng.choice(["a", "b", None]), n, None if n % 17 == 0 else at(rng.randrange(600))) for n in range(80)]
    right = [(rng.choice(["a", "b", None]), None if n % 13 == 0 else at(rng.randrange(600)), n) for n in range(60)]
    expected = []
    for k, n, t in left:
        found = [(s, m) for j, s, m in right if j == k is not None and s is not None and t is not None and 0 <= (t - s).total_seconds() <= within]
        expected.append((k, n, t, max(found) if found else None))
    got = latest_before(spark.createDataFrame(left, "k string, n int, t timestamp"), spark.createDataFrame(right, "k string, s timestamp, m int"), ["k"], "t", "s", within)
    assert sorted(((r["k"], r["n"], r["t"], r["found"] and tuple(r["found"])) for r in got.collect()), key=str) == sorted(expected, key=str)


# trip updates


def feed(*updates):
    return encode({"header": {"gtfs_realtime_version": "2.0"}, "entity": [{"id": str(k), "trip_update": u} for k, u in enumerate(updates)]})


UPDATE = {
    "trip": {"trip_id": "t1", "route_id": "r"},
    "vehicle": {"id": "v"},
    "timestamp": str(int(datetime(2026, 1, 5, 8).timestamp())),
    "delay": 30,
    "stop_time_update": [
        {"stop_sequence": 2, "arrival": {"delay": -90, "uncertainty": 5}},
        {"stop_sequence": 4, "schedule_relationship": "NO_DATA"},
        {"stop_sequence": 5, "departure": {"time": "1767600360"}},  # 08:06
        {"stop_sequence": 6, "schedule_relationship": "SKIPPED"},
    ],
}


def test_trip_updates_on_the_wire(spark):
    got = decode_feed(feed(UPDATE))[0]["trip_update"]
    assert got == UPDATE
    with pytest.raises(FeedError, match="trip"):
        decode_feed(feed({"delay": 1, "stop_time_update": []}))
    rows = entities(spark.createDataFrame([(feed(UPDATE, {"trip": {"trip_id": "t2"}, "timestamp": "5", "delay": 7, "stop_time_update": []}),)], "content binary"))
    found = predictions.stop_updates(rows).orderBy("trip_id", "stop_sequence").collect()
    assert [(r["trip_id"], r["stop_sequence"], r["delay"], r["trip_delay"]) for r in found] == [("t1", 2, -90, 30), ("t1", 4, None, 30), ("t1", 5, None, 30), ("t1", 6, None, 30), ("t2", None, None, 7)]
    assert found[2]["predicted_time"] == datetime(2026, 1, 5, 8, 6)


TIMES = "trip_id string, stop_sequence int, arrival_time string, departure_time string"


def test_delays_are_carried_to_later_stops(spark):
    times = spark.createDataFrame([("t1", n, f"08:{n:02d}:00", None) for n in range(1, 9)] + [("t3", 1, "08:00:00", None)], TIMES)
    updates = predictions.stop_updates(entities(spark.createDataFrame([(feed(UPDATE),)], "content binary")))
    got = predictions.predicted_arrivals(updates, times, "UTC").orderBy("stop_sequence").collect()
    by = {r["stop_sequence"]: int((r["predicted_time"] - T0).total_seconds()) for r in got}
    # the trip's delay, then a stop's, none after NO_DATA, a time as a delay, nothing for the skipped stop, which passes it on
    assert by == {1: 60 + 30, 2: 120 - 90, 3: 180 - 90, 5: 360, 7: 420 + 60, 8: 480 + 60}


def test_each_arrival_has_one_prediction(spark):
    predicted = spark.createDataFrame([("t", 1, at(0), at(500)), ("t", 1, at(100), at(420)), ("t", 1, at(400), at(1)), ("t", 2, at(0), at(9))], "trip_id string, stop_sequence int, made_at timestamp, predicted_time timestamp")
    pings = [("t", 1, "IN_TRANSIT_TO", at(200)), ("t", 1, "STOPPED_AT", at(399)), ("t", 1, "STOPPED_AT", at(700)), ("t", 9, "STOPPED_AT", at(1)), (None, 1, "STOPPED_AT", at(1)), ("t", 2, "STOPPED_AT", at(8000))]
    seen = predictions.arrivals(spark.createDataFrame(pings, "trip_id string, current_stop_sequence int, current_status string, timestamp timestamp"), "UTC")
    rows = predictions.judged(predicted, seen)
    assert [(r["stop_sequence"], r["minutes_ahead"], r["error_seconds"]) for r in rows.collect()] == [(1, 4, -21)]  # the last made before it
    assert rows_of(predictions.prediction_error(rows)) == [(4, 1, -21.0, 21.0)]


# bunching


def test_consecutive_vehicles_bunch(spark):
    # scheduled 600 s apart; metres north along a meridian
    def ping(vehicle, trip, stop, sequence, seconds, meters):
        return (vehicle, trip, stop, sequence, at(seconds), 42.0 + meters / 111_320, -71.0)

    pings = [
        ping("a", "t1", "s1", 1, 0, 0),
        ping("a", "t1", None, 2, 110, 150),  # where the leader is when the follower comes
        ping("b", "t2", "s1", 1, 120, 0),  # 120 of 600 s behind, 150 m away: bunched
        ping("c", "t3", "s1", 1, 500, 0),  # b is 380 of 600 s ahead: not below half
        ping("d", "u1", "s1", 1, 505, 0),  # the other direction
        ping("e", "t4", "s1", 1, 700, 0),  # close in time to c, but c isn't near any more
        ping("c", "t3", None, 2, 690, 5000),
        ping("c", "t9", "s1", 1, 705, 0),  # no schedule
    ]
    trips = spark.createDataFrame([(t, "r", int(t[0] == "u")) for t in ("t1", "t2", "t3", "t4", "t9", "u1")], "trip_id string, route_id string, direction_id int")
    times = spark.createDataFrame([("t1", 1, "08:00:00", None), ("t2", 1, "08:10:00", None), ("t3", 1, "08:20:00", None), ("t4", 1, "08:30:00", None), ("u1", 1, "08:00:00", None)], TIMES)
    df = spark.createDataFrame(pings, "vehicle_id string, trip_id string, stop_id string, current_stop_sequence int, timestamp timestamp, lat double, lon double")
    got = bunching.bunched(df, trips, times, 200, 0.5, "UTC").collect()
    assert [(r["leader"], r["follower"], r["headway_seconds"], r["scheduled_headway_seconds"], round(r["meters"])) for r in got] == [("a", "b", 120, 600, 150)]
    assert bunching.bunched(df, trips, times, 100, 0.5, "UTC").count() == 0


def test_near_vehicles_against_all_pairs(spark):
    rng = random.Random(3)
    spots = [(f"v{k}", f"r{k % 2}", at(3600 * (k % 3)), 42 + rng.random() / 1500, -71 - rng.random() / 1500) for k in range(90)]

    def meters(a, b):
        return math.hypot((b[3] - a[3]) * 111_320, (b[4] - a[4]) * 111_320 * math.cos(math.radians((a[3] + b[3]) / 2)))

    expected = {(*sorted((a[0], b[0])), round(meters(a, b), 3)) for a in spots for b in spots if a[0] < b[0] and a[1:3] == b[1:3] and meters(a, b) <= 40}
    df = extensions.bunching(spark.createDataFrame(spots, "vehicle_id string, route_id string, timestamp timestamp, lat double, lon double"), 40, 3600)
    got = [(r["vehicle_a"], r["vehicle_b"], r["meters"]) for r in df.collect()]
    assert 50 < len(expected) == len(got) and set(got) == expected
    # the result grows with the square of a crowd, so nothing in a row of it goes through decimal text
    assert " round(" not in df._jdf.queryExecution().executedPlan().toString()


def test_a_crowd_is_dealt_over_tasks(spark):
    """A route and hour of many vehicles on two bands of latitude: each near pair once, and no task has all of them."""
    rng = random.Random(4)
    spots = [(f"v{k}", "r", at(0), 42 + rng.random() / 1500, -71 - rng.random() / 1500) for k in range(1500)]
    spots += [(None, "r", at(0), 42.0003, -71.0003)]  # paired with nothing, as in SQL
    schema = "vehicle_id string, route_id string, timestamp timestamp, lat double, lon double"
    lat, lon = (np.array([s[k] for s in spots[:-1]]) for k in (3, 4))
    middle = np.radians((lat[:, None] + lat) / 2)
    meters = np.hypot((lat[:, None] - lat) * 111_320, (lon[:, None] - lon) * 111_320 * np.cos(middle))
    expected = {tuple(sorted((f"v{i}", f"v{k}"))) for i, k in zip(*np.nonzero(np.triu(meters <= 40, 1)), strict=True)}
    few = spark.createDataFrame(spots, schema)
    for crowd in (1500, 400, 37):
        got = [(r["vehicle_a"], r["vehicle_b"]) for r in extensions.bunching(few, 40, 3600, crowd).select("vehicle_a", "vehicle_b").collect()]
        assert len(got) == len(expected) > 100_000 and set(got) == expected

    many = spark.range(6000).selectExpr("concat('v', id) AS vehicle_id", "'r' AS route_id", "timestamp'2024-01-01' AS timestamp", "42.0001D AS lat", "-71 - id / 1e6D AS lon")
    by = [r["count"] for r in extensions.bunching(many, 40, 3600).groupBy(F.spark_partition_id()).count().collect()]
    assert sum(by) == sum(min(483, 5999 - k) for k in range(6000)) and max(by) < 0.9 * sum(by)  # one task had all of them


# bottlenecks


def plain_clusters(cells):
    left, out = set(cells), {}
    for start in sorted(cells):
        if start in left:
            queue, found = [start], {start}
            left.remove(start)
            while queue:
                y, x = queue.pop()
                for near in [(y + j, x + i) for j in (-1, 0, 1) for i in (-1, 0, 1)]:
                    if near in left:
                        left.remove(near)
                        found.add(near)
                        queue.append(near)
            out |= {c: min(found) for c in found}
    return out


SHAPES = {
    "random": {(random.Random(k).randrange(-15, 15), random.Random(k + 999).randrange(-15, 15)) for k in range(200)},
    "long": {(0, x) for x in range(120)} | {(y, 119 if y % 4 < 2 else 0) for y in range(1, 20)},
    "spiral": {(y, x) for y in range(-9, 10) for x in range(-9, 10) if max(abs(x), abs(y)) % 2 == 0 and not (y == 0 and x > 0)},
    "none": set(),
}


@pytest.mark.parametrize("shape", sorted(SHAPES))
def test_clusters(spark, shape):
    cells = SHAPES[shape]
    df = spark.createDataFrame([(y, x, 4, 4, 1.0) for y, x in cells], "cell_lat long, cell_lon long, n long, n_slow long, mean_mps double")
    got = {(r["cell_lat"], r["cell_lon"]): (r["cluster_lat"], r["cluster_lon"]) for r in bottlenecks.clusters(df).collect()}
    assert got == plain_clusters(cells)
    assert bottlenecks.bottlenecks(df).count() == len(set(got.values()))
