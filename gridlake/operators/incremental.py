"""Incremental writes on day-partitioned Parquet tables, which have no MERGE.

A write computes the new content of touched days alone, stages it and then swaps those partitions by a journal
(``operators.swap``), so a plan never reads files that it overwrites, and days without news aren't read at all.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import swap
from .keyed import keep_one
from .swap import exists, read


def create_if_missing(spark: SparkSession, path: str, schema: T.StructType, partition: str = "date", name: str | None = None) -> DataFrame:
    """The catalog table at a path, with the partitions it has by now; an empty one with the schema and partition is made if there is none."""
    name = name or "table_" + hashlib.md5(path.encode()).hexdigest()
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(folder)
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet PARTITIONED BY (`{partition}`) LOCATION '{path}'")
    spark.sql(f"MSCK REPAIR TABLE {name}")
    return spark.table(name).select(schema.names)


def replace_partitions(df: DataFrame, path: str, partition: str = "date") -> None:
    """Overwrite the partitions that ``df`` has rows for; others stay. A stop at any point leaves the old rows or the new ones."""
    swap.replace(df, path, partition)


def rebuild(df: DataFrame, path: str, partition: str | None = None) -> None:
    writer = df.write.mode("overwrite").option("partitionOverwriteMode", "static")
    (writer.partitionBy(partition) if partition else writer).parquet(path)


def since_watermark(target: DataFrame, source: DataFrame, column: str = "date", lookback_days: int = 0) -> DataFrame:
    """Source rows from the target's last day less the lookback; all of them for an empty target."""
    last = F.broadcast(target.agg(F.date_sub(F.max(column), lookback_days).alias("_from")))
    return source.crossJoin(last).where(F.col("_from").isNull() | (F.col(column) >= F.col("_from"))).drop("_from")


def touched(target: DataFrame, news: DataFrame, partition: str = "date") -> DataFrame:
    """Target rows of the partitions in which news arrive."""
    return target.join(news.select(partition).distinct(), partition, "left_semi")


def merged(target: DataFrame, news: DataFrame, keys: Sequence[str], newest: str | None = None) -> DataFrame:
    """Rows after an upsert: news, and target rows whose key has none. With ``newest``, the row with the greatest value there stays, news on ties."""
    if newest is None:
        return target.join(news, list(keys), "left_anti").unionByName(news)
    both = target.withColumn("_new", F.lit(0)).unionByName(news.withColumn("_new", F.lit(1)))
    return keep_one(both, keys, F.col(newest).desc_nulls_last(), F.col("_new").desc()).drop("_new")


def upsert(news: DataFrame, path: str, keys: Sequence[str], partition: str = "date", newest: str | None = None) -> None:
    """Update or insert by key, one job for all rows; doing it twice changes nothing.

    ``newest`` names a column that tells later rows from earlier ones: a row never gives way to an earlier one, in whatever
    order they come.
    """
    spark = news.sparkSession
    swap.recover(spark, path)
    if not exists(spark, path):
        return replace_partitions(news if newest is None else keep_one(news, keys, F.col(newest).desc_nulls_last()), path, partition)
    target = read(spark, path).select(news.columns)
    return replace_partitions(merged(touched(target, news, partition), news, keys, newest), path, partition)


def insert_once(news: DataFrame, path: str, keys: Sequence[str], partition: str = "date", order: str | None = None) -> None:
    """Insert rows whose key the table lacks; the first row of a key, by ``order`` if given, stays for good.

    Where the partition is part of the key, only the table's partitions in which news arrive are read.
    """
    spark = news.sparkSession
    swap.recover(spark, path)
    first = keep_one(news, keys, *([F.col(order)] if order else []))
    if exists(spark, path):
        held = read(spark, path).select(*{*keys, partition})
        held = touched(held, news, partition) if partition in keys else held
        first = first.join(held.select(*keys), list(keys), "left_anti")
    first.write.mode("append").partitionBy(partition).parquet(path)


def delete_matching(path: str, done: DataFrame, keys: Sequence[str], partition: str = "date") -> None:
    """Delete rows whose key ``done`` has; a partition that would be empty is removed with its rows' last copy."""
    swap.recover(done.sparkSession, path)
    target = read(done.sparkSession, path)
    hit = touched(target, target.join(done.select(*keys), list(keys), "left_semi"), partition)
    kept = hit.join(done.select(*keys), list(keys), "left_anti")
    # One row for each day that is left without any.
    emptied = [r[0] for r in hit.select(partition).distinct().join(kept.select(partition).distinct(), partition, "left_anti").collect()]
    swap.replace(kept.select(target.columns), path, partition, emptied)


def window_input(table: DataFrame, since, rows_back_hours: int = 168, partition: str = "date") -> DataFrame:
    """What a trailing window needs to rewrite days from ``since`` on: those days and the hours before them that it reaches."""
    days = -(-rows_back_hours // 24)
    return table.where(F.col(partition) >= F.date_sub(F.lit(since).cast("date"), days))
