"""Places of rows in one global order, without one task that sorts them all."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridlake.sources import shared


def _ranges(df: DataFrame, order: list[Column], write: Callable[[DataFrame], DataFrame], at: str) -> DataFrame:
    """``df`` cut into ranges of ``order`` and written, with ``at``: the number of the range above bit 33, the place in it below.

    Rows that tie are told apart by where they were read, so that one value held by most rows is still cut into many ranges.
    """
    tie = f"{at}_tie"
    keys = [*order, F.col(tie)]
    placed = df.withColumn(tie, F.monotonically_increasing_id()).repartitionByRange(*keys).sortWithinPartitions(*keys)
    return write(placed.withColumn(at, F.monotonically_increasing_id()).drop(tie))


def _before(stored: DataFrame, at: str, amount: Column, name: str) -> DataFrame:
    """For each range what all ranges before it hold; a row a range, of which there are as many as shuffle partitions."""
    sizes = stored.groupBy(F.shiftright(at, 33).alias("_part")).agg(amount.alias("_n"))
    lower = F.coalesce(F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return F.broadcast(sizes.select("_part", lower.alias(name)))


def ranked(df: DataFrame, order: list[Column], name: str = "rank", write: Callable[[DataFrame], DataFrame] = shared.written) -> DataFrame:
    """``df`` with the place (1, 2, 3 ...) of each row in ``order``; rows that tie get places of their own, in any order.

    ``df`` is read twice (ranges come from a sample), so pass a table that is cheap to read.
    """
    at, lower = f"_{name}_at", f"_{name}_lower"
    stored = _ranges(df, order, write, at)
    inner = F.col(at).bitwiseAND((1 << 33) - 1)
    found = stored.join(_before(stored, at, F.count("*"), lower), F.shiftright(at, 33) == F.col("_part"))
    return found.withColumn(name, F.col(lower) + inner + 1).drop("_part", lower, at)


def running_total(df: DataFrame, order: list[Column], value: str, write: Callable[[DataFrame], DataFrame] = shared.written) -> DataFrame:
    """``df`` with ``{value}_before``, the sum of ``value`` over all rows earlier in ``order``, which must not tie."""
    at, lower = "_total_at", "_total_lower"
    stored = _ranges(df, order, write, at)
    found = stored.join(_before(stored, at, F.sum(value), lower), F.shiftright(at, 33) == F.col("_part"))
    earlier = Window.partitionBy("_part").orderBy(at).rowsBetween(Window.unboundedPreceding, -1)
    return found.withColumn(f"{value}_before", F.col(lower) + F.coalesce(F.sum(value).over(earlier), F.lit(0))).drop("_part", lower, at)
