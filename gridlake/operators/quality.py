"""Data-quality operators: each returns the rows that fail, or a table of figures."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

C = F.col


def not_null(df: DataFrame, column: str) -> DataFrame:
    return df.where(C(column).isNull())


def unique(df: DataFrame, *columns: str) -> DataFrame:
    """Keys that more than one row has, with their number."""
    return df.groupBy(*columns).agg(F.count("*").alias("n")).where("n > 1")


def accepted_values(df: DataFrame, column: str, values: Sequence) -> DataFrame:
    return df.where(~C(column).isin(list(values)))


def accepted_range(df: DataFrame, column: str, least=None, most=None) -> DataFrame:
    """Rows outside the bounds that are given."""
    low = F.lit(False) if least is None else C(column) < least
    return df.where(low | (F.lit(False) if most is None else C(column) > most))


def calendar(df: DataFrame, until: Column, column: str = "date") -> DataFrame:
    """All days from a table's first one to ``until``, whether the table still has rows then or not; none for an empty table."""
    ends = df.agg(F.min(column).alias("a"))
    last = until.cast("date")
    return ends.where(C("a") <= last).select(F.explode(F.sequence("a", last)).alias("date"))


def hourly_gaps(df: DataFrame, as_of, excused_days: int = 2) -> DataFrame:
    """(date, hour) without a row, from the first day on; the last days before ``as_of`` may still lack hours."""
    days = calendar(df, F.date_sub(F.lit(as_of).cast("date"), excused_days + 1))
    every = days.select("date", F.explode(F.sequence(F.lit(0), F.lit(23))).alias("hour"))
    return every.join(df.select("date", "hour").distinct(), ["date", "hour"], "left_anti")


def check_results(checks: dict[tuple[str, str], DataFrame]) -> DataFrame:
    """(check, severity, failures) of named checks, one aggregate each, in one job."""
    rows = [bad.agg(F.count("*").alias("failures")).select(F.lit(name).alias("check"), F.lit(severity).alias("severity"), "failures") for (name, severity), bad in checks.items()]
    return reduce(DataFrame.unionByName, rows)


def stop_on_errors(results: DataFrame) -> None:
    """Raise if a check of severity ``error`` has failures."""
    bad = [r["check"] for r in results.where("severity = 'error' AND failures > 0").collect()]
    if bad:
        raise ValueError(f"failed checks: {', '.join(sorted(bad))}")


def freshness(df: DataFrame, name: str, instant: str, as_of, warn_hours: int, error_hours: int) -> DataFrame:
    last = F.max(instant)
    age = F.timestamp_diff("HOUR", C("last"), F.lit(as_of).cast("timestamp"))
    status = F.when(age.isNull() | (age > error_hours), "error").when(age > warn_hours, "warn").otherwise("ok")
    return df.agg(last.alias("last")).select(F.lit(name).alias("source"), "last", age.alias("age_hours"), status.alias("status"))


def coverage(df: DataFrame, name: str, value: str, as_of, least: float = 0.0) -> DataFrame:
    """One row of figures on an hourly table: span, nulls, low values, days, completeness, age and a status."""
    days = F.date_diff(C("max_date"), C("min_date")) + 1
    one = df.agg(
        F.min("date").alias("min_date"), F.max("date").alias("max_date"), F.count("*").alias("n_rows"), F.count_if(C(value).isNull()).alias("nulls"), F.count_if(C(value) < least).alias("low"),
        F.count_distinct("date").alias("n_days"), F.count_distinct("date", "hour").alias("n_hours"),
    )
    complete, stale = F.round(100.0 * C("n_hours") / (24 * days), 2), F.date_diff(F.lit(as_of).cast("date"), "max_date")
    status = F.when(C("n_rows") == 0, "ERROR").when((complete < 80) | (stale > 7), "ERROR").when((complete < 98) | (stale > 2), "WARN").otherwise("OK")
    return one.select(
        F.lit(name).alias("table_name"), "min_date", "max_date", "n_rows", F.round(100.0 * C("nulls") / C("n_rows"), 2).alias("null_pct"), F.round(100.0 * C("low") / C("n_rows"), 2).alias("low_pct"),
        "n_days", "n_hours", complete.alias("completeness_pct"), stale.alias("days_stale"), status.alias("status"),
    )


def short_days(df: DataFrame, hours: int = 24, top: int = 20) -> DataFrame:
    """The days with the fewest rows below ``hours``."""
    return df.groupBy("date").agg(F.count("*").alias("n_rows")).where(C("n_rows") < hours).orderBy("n_rows", "date").limit(top)


def missing_days(df: DataFrame, as_of) -> DataFrame:
    """Days without a row from the first one to ``as_of``."""
    return calendar(df, F.lit(as_of)).join(df.select("date").distinct(), "date", "left_anti").agg(F.count("*").alias("missing_days"))


def mart_health(tables: dict[str, DataFrame], as_of, stale_days: int = 3) -> DataFrame:
    """Rows, range and OK / STALE / EMPTY of each table; a name without a table is MISSING."""
    rows = []
    for name, df in tables.items():
        one = df.agg(F.count("*").alias("n_rows"), F.min("date").alias("min_date"), F.max("date").alias("max_date"))
        status = F.when(C("n_rows") == 0, "EMPTY").when(F.date_diff(F.lit(as_of).cast("date"), "max_date") > stale_days, "STALE").otherwise("OK")
        rows.append(one.select(F.lit(name).alias("mart"), "n_rows", "min_date", "max_date", status.alias("status")))
    return reduce(DataFrame.unionByName, rows)


def price_sanity(df: DataFrame, price: str = "ptf_try", ceiling: float = 10_000) -> DataFrame:
    p = C(price)
    return df.agg(F.avg(p).alias("avg_price"), F.min(p).alias("min_price"), F.max(p).alias("max_price"), F.stddev_samp(p).alias("std_price"), F.count_if(p <= 0).alias("not_positive"), F.count_if(p > ceiling).alias("above_ceiling"))


def group_coverage(df: DataFrame, group: str) -> DataFrame:
    """Rows, days and span of each group, for instance of each city."""
    return df.groupBy(group).agg(F.count("*").alias("n_rows"), F.count_distinct("date").alias("n_days"), F.min("date").alias("min_date"), F.max("date").alias("max_date"))


def day_coverage(df: DataFrame) -> DataFrame:
    """Share of the calendar's days on which a table has events."""
    return df.agg(F.count_distinct("date").alias("n_days"), (F.date_diff(F.max("date"), F.min("date")) + 1).alias("expected")).withColumn("coverage_pct", F.round(100.0 * C("n_days") / C("expected"), 2))


def score_card(results: DataFrame) -> DataFrame:
    """Counts by status and mean completeness of tables that aren't over-full."""
    status = lambda s: F.count_if(C("status") == s)
    return results.agg(status("OK").alias("n_ok"), status("WARN").alias("n_warn"), status("ERROR").alias("n_error"), F.round(F.avg(F.when(C("completeness_pct") <= 110, C("completeness_pct"))), 2).alias("mean_completeness"))


def cross_partition_duplicates(df: DataFrame, keys: Sequence[str], partition: str | Column) -> DataFrame:
    """Keys that stand in more than one partition."""
    p = C(partition) if isinstance(partition, str) else partition
    return df.groupBy(*keys).agg(F.count_distinct(p).alias("partitions")).where("partitions > 1")
