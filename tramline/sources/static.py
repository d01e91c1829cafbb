"""Static schedule tables from CSV: all text, a byte-order mark in the header is dropped."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tramline.schemas import STOP_TIMES, STOPS, TRIPS


def csv_table(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    """The named columns as text, NULL where the file has no such column."""
    raw = spark.read.option("header", True).option("inferSchema", False).option("mode", "PERMISSIVE").csv(path)
    raw = raw.toDF(*[c.lstrip("﻿").strip() for c in raw.columns])
    return raw.select(*[F.col(c) if c in raw.columns else F.lit(None).cast("string").alias(c) for c in columns])


def stops(spark: SparkSession, path: str) -> DataFrame:
    rows = csv_table(spark, path, STOPS)
    return rows.withColumns({c: F.col(c).try_cast("double") for c in ("stop_lat", "stop_lon")})


def stop_times(spark: SparkSession, path: str) -> DataFrame:
    return csv_table(spark, path, STOP_TIMES).withColumn("stop_sequence", F.col("stop_sequence").try_cast("int"))


def trips(spark: SparkSession, path: str) -> DataFrame:
    return csv_table(spark, path, TRIPS).withColumn("direction_id", F.col("direction_id").try_cast("int"))


def version(rows: DataFrame) -> DataFrame:
    """One row with the number of rows and an order-free checksum: a changed table has another."""
    return rows.agg(F.count("*").alias("n_rows"), F.bit_xor(F.xxhash64(*rows.columns)).alias("checksum"))
