"""The folder in which tables are handed from one job to the next."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def folder(spark: SparkSession) -> str:
    """A new folder beside shared checkpoints. Where there are none, a local session gets one of its own and a cluster an error."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = "file://" + tempfile.mkdtemp(prefix="spark-tables-")
    return f"{base.rstrip('/')}/tables-{uuid.uuid4().hex}"


def written(df: DataFrame) -> DataFrame:
    """The table, written once and read back."""
    path = folder(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def dealt(df: DataFrame, rows: int, *keys: str, each: int = 400_000) -> DataFrame:
    """``df`` by ``keys`` in partitions of about ``each`` of its ``rows``, which grow in number and not in size with the table.

    Spark joins small partitions up to a size in compressed bytes, and short keys and sums of many rows take few of them.
    """
    return df.repartition(max(df.sparkSession.sparkContext.defaultParallelism, -(-rows // each)), *keys)
