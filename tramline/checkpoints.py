"""Cutting lineage in jobs that repeat."""

from __future__ import annotations

import re
import tempfile
import uuid
from functools import cache

from pyspark.sql import DataFrame, SparkSession


@cache
def local_dir() -> str:
    return f"file://{tempfile.mkdtemp(prefix='tramline-')}"


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder of the session's spark.checkpoint.dir. Where that is unset, a session on one machine gets a new local one; on a cluster that is an error."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if found:
        return found
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return local_dir()


def new_folder(spark: SparkSession, name: str) -> str:
    """A folder of its own in the shared folder; it goes when the driver ends."""
    folder = f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    files.mkdirs(path)
    files.deleteOnExit(path)
    return folder


def exists(spark: SparkSession, path: str) -> bool:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at)


def checkpointed(df: DataFrame) -> DataFrame:
    """The rows, written once, without their lineage; a lost executor repeats only what follows."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(checkpoint_dir(df.sparkSession))
    return df.checkpoint()
