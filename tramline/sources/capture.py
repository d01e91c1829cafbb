"""A capture of a message log that ends by itself: after so many messages, so much time, or at the log's end."""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tramline.settings import SAMPLE_MESSAGES, SAMPLE_SECONDS, TOPIC
from tramline.checkpoints import new_folder


@dataclass
class Capture:
    """How many messages were taken, and what ended the capture: messages, time, or the log's end."""

    messages: int = 0
    ended_by: str = "end"
    batches: list[int] = field(default_factory=list)


def stream_kafka(spark: SparkSession, brokers: str, topic: str = TOPIC, per_trigger: int = SAMPLE_MESSAGES // 4) -> DataFrame:
    """The log from its earliest offsets. Nothing is committed to the broker, and each query has a group of its own."""
    source = spark.readStream.format("kafka").option("kafka.bootstrap.servers", brokers).option("subscribe", topic)
    return source.option("startingOffsets", "earliest").option("maxOffsetsPerTrigger", per_trigger).load()


def capture(stream: DataFrame, path: str, messages: int = SAMPLE_MESSAGES, seconds: float = SAMPLE_SECONDS, clock: Callable[[], float] = time.monotonic) -> Capture:
    """Writes a stream's rows to `path`, until there are `messages` of them, `seconds` have passed, or what the log held at the start is read.

    How much one trigger reads is bounded by the source (maxFilesPerTrigger, maxOffsetsPerTrigger), so the capture ends
    soon after its time. It keeps no offsets: another capture begins anew. An error of the source is raised. Without any
    rows nothing is written.
    """
    spark, taken, began = stream.sparkSession, Capture(), clock()
    path = path.rstrip("/")

    def each(batch: DataFrame, batch_id: int) -> None:
        if taken.messages >= messages:
            return
        if clock() - began >= seconds:
            taken.ended_by = "time"
            return
        seen = Observation()
        rows = batch.limit(messages - taken.messages).observe(seen, F.count("*").alias("n"))
        rows.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")
        taken.messages += seen.get["n"]
        taken.batches.append(batch_id)
        if taken.messages >= messages:
            taken.ended_by = "messages"

    query = stream.writeStream.foreachBatch(each).option("checkpointLocation", new_folder(spark, "capture")).trigger(availableNow=True).start()
    try:
        while not query.awaitTermination(0.2):
            if taken.ended_by != "end":
                break
            if clock() - began >= seconds:
                taken.ended_by = "time"
                break
    finally:
        query.stop()
    if query.exception() is not None:
        raise query.exception()
    return taken


def captured(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The messages of a capture; none if nothing was written."""
    return spark.read.schema(schema).parquet(path).drop("batch")
