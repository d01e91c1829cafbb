"""The ingestion job: polls a feed, decodes and validates each snapshot, and appends messages to the log."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.readwriter import DataStreamWriter

from tramline.operators import validate
from tramline.settings import AGENCY_ID, POLL_SECONDS, TOPIC, TOPIC_PARTITIONS
from tramline.sources import feed, messages
from tramline.sources.polling import FeedSource
from tramline.streaming.live import counted


def snapshots(spark: SparkSession, **options: str) -> DataFrame:
    """A row for each poll of a feed; options are those of FeedSource."""
    spark.dataSource.register(FeedSource)
    return spark.readStream.format(FeedSource.name()).options(**options).load()


def feed_messages(polled: DataFrame, agency_id: str = AGENCY_ID) -> DataFrame:
    """Messages (key, value) of the valid entities of snapshots (binary column content).

    Published and skipped counts are observed as "cycle" (see supervised.CycleLog). A snapshot that isn't a feed message
    is an error, which ends the query; the supervisor starts it again.
    """
    rows = counted(validate.checked(feed.entities(polled)))
    return messages.envelope(validate.telemetry(rows), agency_id)


def to_log(rows: DataFrame, path: str, partitions: int = TOPIC_PARTITIONS) -> DataStreamWriter:
    """Each micro-batch becomes files of `path`/partition=P that it alone writes; a repeated batch is not written twice (file sink)."""
    dealt = rows.withColumn("partition", F.pmod(F.hash("key"), F.lit(partitions)).cast("int")).withColumn("timestamp", F.current_timestamp())
    return dealt.writeStream.format("parquet").option("path", path).partitionBy("partition")


def to_kafka(rows: DataFrame, brokers: str, topic: str = TOPIC) -> DataStreamWriter:
    return rows.writeStream.format("kafka").options(**messages.producer_options(brokers, topic))


def scheduled(writer: DataStreamWriter, checkpoint: str, seconds: int = POLL_SECONDS) -> DataStreamWriter:
    """A poll each `seconds`, from where the checkpoint left off; the caller starts it, or supervised.supervised does."""
    return writer.option("checkpointLocation", checkpoint).trigger(processingTime=f"{seconds} seconds")
