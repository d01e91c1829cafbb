"""Structured Streaming forms of the operators."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tramline.operators.quality import OUTAGE_VEHICLES, order_of_rows

KEY = ("vehicle_id", "timestamp")
#: Above the latest report that the feed has shown (2,163 s).
LATENESS = "40 minutes"
SILENT_SECONDS = 77
STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def use_rocksdb(spark: SparkSession) -> None:
    """Set before a query with the stateful processors is built."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_STORE)


def deduplicated(pings: DataFrame, tiebreak: Sequence[str] = (), lateness: str = LATENESS) -> DataFrame:
    """The best ping of each (vehicle_id, timestamp), as quality.latest picks it: the latest ingested.

    The state of a key is its best row so far. It is given out, once, when the watermark passes its timestamp; from then
    on its duplicates are late and refused. A restart from the checkpoint goes on with the same state.
    """
    rows = pings.withWatermark("timestamp", lateness)
    best = F.max_by(F.struct(*pings.columns), F.struct(*order_of_rows(pings, tiebreak)))
    found = rows.groupBy(*KEY).agg(best.alias("_row"))
    return found.select(*[F.col(c) if c in KEY else F.col(f"_row.{c}").alias(c) for c in pings.columns])


def distinct_vehicles(gap_rows: DataFrame, minutes: int = 1, lateness: str = LATENESS, least_seconds: float = SILENT_SECONDS) -> DataFrame:
    """(minute, n_vehicles): how many vehicles have a large gap that began in each window; exact, as each is counted once.

    Two stateful operators in a row: one lets a vehicle pass once for each window, the other counts them.
    """
    # the condition names the event time, so Spark doesn't move it before the watermark, which short gaps advance too
    is_large = F.when(F.col("prev_timestamp").isNotNull(), F.col("real_update_gap_seconds") >= least_seconds)
    large = gap_rows.withWatermark("prev_timestamp", lateness).filter(is_large)
    seen = large.select("vehicle_id", F.window("prev_timestamp", f"{minutes} minutes").alias("window")).dropDuplicates(["window", "vehicle_id"])
    by = seen.groupBy("window").agg(F.count("*").alias("n_vehicles"))
    return by.select(F.col("window.start").alias("minute"), F.window_time("window").alias("ends"), "n_vehicles")


class Runs(StatefulProcessor):
    """Joins suspect windows that follow each other without a gap, and gives a run out once the watermark tells that it ended."""

    def __init__(self, millis: int):
        self.millis = millis

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.minutes = handle.getMapState("minutes", "start long", "vehicles long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        for batch in rows:
            for at, n in zip(batch["minute"], batch["n_vehicles"], strict=True):
                start = int(at.value // 1_000_000)
                self.minutes.updateValue((start,), (int(n),))
                # by the end of the window after this one, it is known whether that is suspect too
                self.handle.registerTimer(start + 2 * self.millis)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        last = expiredTimerInfo.getExpiryTimeInMs() - 2 * self.millis
        if not self.minutes.containsKey((last,)) or self.minutes.containsKey((last + self.millis,)):
            return  # given out already, or the run goes on
        run, at = [], last
        while self.minutes.containsKey((at,)):
            run.append(self.minutes.getValue((at,))[0])
            self.minutes.removeKey((at,))
            at -= self.millis
        stamps = [pd.Timestamp(x, unit="ms") for x in (at + self.millis, last)]
        yield pd.DataFrame({"window_start": [stamps[0]], "window_end": [stamps[1]], "n_minutes": [len(run)], "most_vehicles": [max(run)]})

    def close(self) -> None:
        pass


def outages(gap_rows: DataFrame, vehicles: int = OUTAGE_VEHICLES, minutes: int = 1, lateness: str = LATENESS, least_seconds: float = SILENT_SECONDS) -> DataFrame:
    """(window_start, window_end, n_minutes, most_vehicles) of each run of suspect windows, as soon as it is known to have ended.

    Suspect windows are those in which so many distinct vehicles fell silent. Chained: distinct vehicles by window, then
    runs of windows. The runs' operator has one key, but gets a row for each suspect window only. Needs use_rocksdb.
    """
    suspect = distinct_vehicles(gap_rows, minutes, lateness, least_seconds).filter(F.col("n_vehicles") >= vehicles)
    runs = suspect.withColumn("feed", F.lit(1)).groupBy("feed")
    schema = "window_start timestamp, window_end timestamp, n_minutes long, most_vehicles long"
    return runs.transformWithStateInPandas(Runs(minutes * 60_000), schema, "Append", "EventTime")


class Silence(StatefulProcessor):
    """Tells a vehicle's silence once the watermark passes its last report by the threshold."""

    def __init__(self, seconds: float):
        self.millis = int(seconds * 1000)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.last = handle.getValueState("last", "millis long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        newest = max(int(r["timestamp"].max().value // 1_000_000) for r in rows)
        before = self.last.get()[0] if self.last.exists() else None
        if before is None or newest > before:
            for timer in list(self.handle.listTimers()):
                self.handle.deleteTimer(timer)
            self.last.update((newest,))
            self.handle.registerTimer(newest + self.millis)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        at = pd.Timestamp(self.last.get()[0], unit="ms")
        self.last.clear()
        yield pd.DataFrame({"vehicle_id": [key[0]], "last_seen": [at]})

    def close(self) -> None:
        pass


class Gaps(StatefulProcessor):
    """The seconds since each vehicle's ping before, as the stream comes; late pings give no gap."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.last = handle.getValueState("last", "millis long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        times = pd.concat([r["timestamp"] for r in rows]).sort_values()
        before = pd.Timestamp(self.last.get()[0], unit="ms") if self.last.exists() else None
        prev = times.shift(1)
        if before is not None:
            prev.iloc[0] = before
        self.last.update((int(max(times.max(), before or times.max()).value // 1_000_000),))
        out = pd.DataFrame({"vehicle_id": key[0], "prev_timestamp": prev, "timestamp": times})
        out["real_update_gap_seconds"] = (out["timestamp"].dt.floor("s") - out["prev_timestamp"].dt.floor("s")).dt.total_seconds()
        out = out[out["real_update_gap_seconds"] >= 0]
        yield out.astype({"real_update_gap_seconds": "int64"})

    def close(self) -> None:
        pass


def silent_vehicles(pings: DataFrame, seconds: float = SILENT_SECONDS, lateness: str = LATENESS) -> DataFrame:
    """(vehicle_id, last_seen) whenever a vehicle falls silent. Needs use_rocksdb."""
    rows = pings.select("vehicle_id", "timestamp").withWatermark("timestamp", lateness)
    return rows.groupBy("vehicle_id").transformWithStateInPandas(Silence(seconds), "vehicle_id string, last_seen timestamp", "Append", "EventTime")


GAP_COLUMNS = "vehicle_id string, prev_timestamp timestamp, timestamp timestamp, real_update_gap_seconds long"


def stream_gaps(pings: DataFrame, lateness: str = LATENESS) -> DataFrame:
    """Gaps of a stream as it comes. Needs use_rocksdb."""
    rows = pings.select("vehicle_id", "timestamp").withWatermark("timestamp", lateness)
    return rows.groupBy("vehicle_id").transformWithStateInPandas(Gaps(), GAP_COLUMNS, "Append", "EventTime")


def deduplicated_gaps(pings: DataFrame, tiebreak: Sequence[str] = (), lateness: str = LATENESS) -> DataFrame:
    """The gaps of quality.gaps over a stream in any order: pings are given out by the dedup once the watermark passes them,
    so those of a vehicle reach its gaps in order, however they came. Needs use_rocksdb."""
    rows = deduplicated(pings, tiebreak, lateness).select("vehicle_id", "timestamp")
    return rows.groupBy("vehicle_id").transformWithStateInPandas(Gaps(), GAP_COLUMNS, "Append", "EventTime")


def silent_batch(pings: DataFrame, seconds: float = SILENT_SECONDS) -> DataFrame:
    """The same for stored pings: vehicles whose last report is older than the newest of all by more than the threshold."""
    last = pings.groupBy("vehicle_id").agg(F.max("timestamp").alias("last_seen"))
    newest = last.agg(F.max("last_seen").alias("newest"))
    rows = last.join(F.broadcast(newest), F.lit(True))
    return rows.filter(F.unix_micros("newest") - F.unix_micros("last_seen") > seconds * 1e6).select("vehicle_id", "last_seen")


def counted(rows: DataFrame, name: str = "cycle") -> DataFrame:
    """Rows with reject_reason, observed: published and skipped counts arrive with each batch's progress."""
    reason = F.col("reject_reason")
    return rows.observe(name, F.count_if(reason.isNull()).alias("published"), F.count(reason).alias("skipped"))
