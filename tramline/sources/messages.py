"""The message log: Kafka where its connector is on the class path, else a Parquet log with the same columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tramline.functions.times import iso_utc
from tramline.schemas import MESSAGE, PING
from tramline.settings import AGENCY_ID, SAMPLE_MESSAGES, TOPIC, TOPIC_PARTITIONS


def envelope(telemetry: DataFrame, agency_id: str = AGENCY_ID, ingested_at: Column | None = None) -> DataFrame:
    """(key, value): the vehicle's id, and JSON of the row with agency_id and ingested_at; nulls are written out."""
    at = F.current_timestamp() if ingested_at is None else ingested_at
    fields = [iso_utc(F.col("timestamp")).alias("timestamp") if c == "timestamp" else F.col(c) for c in telemetry.columns]
    value = F.struct(F.lit(agency_id).alias("agency_id"), *fields, iso_utc(at).alias("ingested_at"))
    return telemetry.select(F.col("vehicle_id").alias("key"), F.to_json(value, {"ignoreNullFields": "false"}).alias("value"))


def to_log(messages: DataFrame, path: str, partitions: int = TOPIC_PARTITIONS) -> int:
    """Appends to a Parquet log in key-hash partitions and returns the number written, counted by the write itself."""
    seen = Observation()
    rows = messages.withColumn("partition", F.pmod(F.hash("key"), F.lit(partitions)).cast("int")).withColumn("timestamp", F.current_timestamp())
    rows.observe(seen, F.count("*").alias("n")).write.mode("append").partitionBy("partition").parquet(path)
    return seen.get["n"]


def producer_options(brokers: str, topic: str = TOPIC) -> dict[str, str]:
    """An idempotent producer; the key's hash picks the partition, so a vehicle's messages stay in order."""
    return {"kafka.bootstrap.servers": brokers, "topic": topic, "kafka.enable.idempotence": "true", "kafka.acks": "all"}


def to_kafka(messages: DataFrame, brokers: str, topic: str = TOPIC) -> None:
    """At least once, as a task may run again; dedup downstream absorbs repeats."""
    messages.select("key", "value").write.format("kafka").options(**producer_options(brokers, topic)).save()


def from_kafka(spark: SparkSession, brokers: str, topic: str = TOPIC, limit: int = SAMPLE_MESSAGES) -> DataFrame:
    """A bounded sample from the earliest offsets, without commits."""
    source = spark.read.format("kafka").option("kafka.bootstrap.servers", brokers).option("subscribe", topic)
    return source.option("startingOffsets", "earliest").load().limit(limit)


def from_log(spark: SparkSession, path: str, limit: int | None = None) -> DataFrame:
    rows = spark.read.parquet(path)
    return rows.limit(limit) if limit is not None else rows


def stream_log(spark: SparkSession, path: str, files_per_trigger: int = 1) -> DataFrame:
    schema = "key string, value string, timestamp timestamp, partition int"
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(path)


def parsed(messages: DataFrame) -> DataFrame:
    """Message values by the declared schema; malformed JSON is an error."""
    value = F.from_json(F.col("value").cast("string"), MESSAGE, {"mode": "FAILFAST"})
    return messages.select(value.alias("m")).select("m.*")


def flattened(telemetry: DataFrame) -> DataFrame:
    """lat and lon beside the other columns; NULL where the location has no such coordinate."""
    point = F.col("location.coordinates")
    return telemetry.withColumn("lon", F.get(point, F.lit(0))).withColumn("lat", F.get(point, F.lit(1)))


def pings(messages: DataFrame) -> DataFrame:
    return flattened(parsed(messages)).select(*PING.fieldNames())


def save_sample(rows: DataFrame, path: str) -> None:
    rows.write.mode("overwrite").parquet(path)
