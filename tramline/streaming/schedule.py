"""Deviation of a stream of pings from a schedule that is reloaded when it changes.

The schedule is a static side with versions. Between micro-batches its files are looked at, at most once in a set time;
if their sizes or times have changed, the table's checksum tells whether the rows have. A new version is written once as
Parquet, and each micro-batch notes which version it used before it writes anything, so a batch that is repeated after
a failure meets the same schedule again, whatever the files say by then.
"""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.readwriter import DataStreamWriter

from tramline.operators.deviation import deviations
from tramline.settings import AGENCY_ZONE
from tramline.sources import static
from tramline.checkpoints import exists

#: Schedules are looked at once a day.
CHECK_SECONDS = 86_400


class Schedule:
    """Versions of a schedule's stop times under `folder`, which all executors share.

    load reads the files of `path` (stop times as CSV, unless given otherwise).
    """

    def __init__(self, spark: SparkSession, path: str, folder: str, load: Callable[[SparkSession, str], DataFrame] = static.stop_times, every: float = CHECK_SECONDS, clock: Callable[[], float] = time.monotonic):
        self.spark, self.path, self.folder, self.load, self.every, self.clock = spark, path, folder.rstrip("/"), load, every, clock
        self.looked: float | None = None
        self.seen: list[tuple[str, int, int]] | None = None
        self.version: str | None = None

    def files(self) -> list[tuple[str, int, int]]:
        """Name, size and time of each file."""
        at = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        found = at.getFileSystem(self.spark._jsc.hadoopConfiguration()).globStatus(self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}{'' if self.path.endswith('*') else '*'}"))
        return sorted((x.getPath().toString(), x.getLen(), x.getModificationTime()) for x in found)

    def current(self) -> str:
        """The present version, after a look at the files if it is time for one."""
        now = self.clock()
        if self.version is not None and now - self.looked < self.every:
            return self.version
        files, self.looked = self.files(), now
        if self.version is None or files != self.seen:
            rows = self.load(self.spark, self.path)
            n, checksum = static.version(rows).first()
            version = f"{n}-{(checksum or 0) & (1 << 64) - 1:016x}"
            if not exists(self.spark, f"{self.folder}/versions/{version}/_SUCCESS"):
                rows.write.mode("overwrite").parquet(f"{self.folder}/versions/{version}")
            self.seen, self.version = files, version
        return self.version

    def rows(self, version: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/versions/{version}")

    def of_batch(self, batch_id: int) -> str:
        """The version that a batch noted, or the present one, which it notes."""
        note = f"{self.folder}/batches/{batch_id}"
        if exists(self.spark, f"{note}/_SUCCESS"):
            return self.spark.read.text(note).first()[0]
        version = self.current()
        self.spark.createDataFrame([(version,)], "value string").coalesce(1).write.mode("overwrite").text(note)
        return version


def deviation_stream(pings: DataFrame, schedule: Schedule, out: str, zone: str = AGENCY_ZONE, actual: str = "timestamp") -> DataStreamWriter:
    """Writes each micro-batch's deviations, with schedule_version, to `out`/batch=N; a repeated batch replaces its own.

    The caller sets the checkpoint and the trigger, and starts it. Spark broadcasts the schedule if its size allows.
    """

    def each(batch: DataFrame, batch_id: int) -> None:
        version = schedule.of_batch(batch_id)
        found = deviations(batch, schedule.rows(version), zone, actual).withColumn("schedule_version", F.lit(version))
        found.write.mode("overwrite").parquet(f"{out.rstrip('/')}/batch={batch_id}")

    return pings.writeStream.foreachBatch(each)
