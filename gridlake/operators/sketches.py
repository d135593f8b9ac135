"""Quantiles from mergeable sketches (KLL): made once for each day, kept, and merged for any span without another scan.

A sketch of up to ``K`` values holds them all, so that its quantiles are exact; beyond, ranks are off by about 1.7 / K of
the number of values (0.02 %), whether days are merged or read at once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import incremental, swap

K = 8192


def made(df: DataFrame, value: str, by: list[str], k: int = K) -> DataFrame:
    """A sketch of ``value`` for each group, with the number and the sum of what it holds."""
    known = df.where(F.col(value).isNotNull())
    return known.groupBy(*by).agg(F.kll_sketch_agg_double(F.col(value).cast("double"), k).alias("sketch"), F.count("*").alias("n"), F.sum(value).alias("total"))


def merged(sketches: DataFrame, by: list[Column | str], k: int = K) -> DataFrame:
    """One sketch for all of a group's sketches; merging takes any order and any grouping before it."""
    return sketches.groupBy(*by).agg(F.kll_merge_agg_double("sketch", k).alias("sketch"), F.sum("n").alias("n"), F.sum("total").alias("total"))


def quantiles(shares: list[float], sketch: str = "sketch") -> Column:
    """For each share the least value that at least this share of values doesn't exceed."""
    return F.kll_sketch_get_quantile_double(sketch, F.array(*[F.lit(float(s)) for s in shares]))


def kept(df: DataFrame, value: str, path: str, day: str = "date", k: int = K) -> DataFrame:
    """Daily sketches at ``path`` with the days of ``df`` made anew, and those of other days as they are.

    Sketches lie in partitions of months, so a day's news touch one small file.
    """
    spark = df.sparkSession
    news = made(df, value, [day], k).withColumn("month", F.date_format(day, "yyyy-MM"))
    incremental.upsert(news, path, [day], "month")
    return swap.read(spark, path)
