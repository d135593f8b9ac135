"""Operators on keyed rows: dedup, hashing, casting, partition columns, joins on the hour."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

HOUR = ["date", "hour"]
#: Keys that dedup falls back to, as far as a table has them.
FALLBACK_KEYS = ["date", "datetime", "hour", "time", "id", "mcp"]


def record_hash(columns: Sequence[str]) -> Column:
    """md5 over the columns as text, joined by ``||``; nulls count as empty."""
    return F.md5(F.concat_ws("||", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns]))


def dedup_keys(df: DataFrame, keys: Sequence[str] | None) -> list[str]:
    """Declared keys if the table has all of them, else the fallback keys it has, else all columns."""
    if keys and set(keys) <= set(df.columns):
        return list(keys)
    return [c for c in FALLBACK_KEYS if c in df.columns] or df.columns


def keep_one(df: DataFrame, keys: Sequence[str], *order: Column) -> DataFrame:
    """One row per key: the first by ``order``, ties broken by all other columns so that reruns agree."""
    rest = [F.xxhash64(*[c for c in df.columns if c not in keys])] if set(df.columns) - set(keys) else []
    w = Window.partitionBy(*keys).orderBy(*order, *rest)
    return df.withColumn("_rank", F.row_number().over(w)).where("_rank = 1").drop("_rank")


def keyed_dedup(df: DataFrame, keys: Sequence[str] | None = None) -> DataFrame:
    """Dedup with the fallback rule; of a key's rows the one with the greatest values stays, column by column in their order, nulls last."""
    found = dedup_keys(df, keys)
    rest = [c for c in df.columns if c not in found]
    if not rest:
        return df.select(found).distinct()
    return keep_one(df, found, *[F.col(c).desc_nulls_last() for c in rest])


def with_record_hash(df: DataFrame, keys: Sequence[str] | None) -> DataFrame:
    """``_record_hash`` over the declared keys; tables without declared keys get none."""
    return df.withColumn("_record_hash", record_hash([k for k in keys if k in df.columns])) if keys else df


def cast_present(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """Cast the listed columns that exist, in one projection; a value that doesn't fit becomes null."""
    return df.select(*[F.col(c).try_cast(types[c]).alias(c) if c in types else F.col(c) for c in df.columns])


def cast_all_but(df: DataFrame, keep: Sequence[str], to: str = "double") -> DataFrame:
    return df.select(*[F.col(c) if c in keep else F.col(c).try_cast(to).alias(c) for c in df.columns])


def rename_present(df: DataFrame, names: dict[str, str]) -> DataFrame:
    return df.withColumnsRenamed({a: b for a, b in names.items() if a in df.columns})


def day_partitions(df: DataFrame, instant: str | Column | None = None, run_date: str | None = None) -> DataFrame:
    """Text columns year, month, day from a row's own time, else from the run date."""
    at = F.lit(run_date).cast("date") if instant is None else (F.col(instant) if isinstance(instant, str) else instant)
    return df.withColumns({"year": F.date_format(at, "yyyy"), "month": F.date_format(at, "MM"), "day": F.date_format(at, "dd")})


def parse_instant(c: str | Column, *formats: str) -> Column:
    """The first of several readings of text as a UTC instant: ISO 8601 with offset, the given formats, then a plain cast."""
    text = (F.col(c) if isinstance(c, str) else c).cast("string")
    tries = [F.try_to_timestamp(text, F.lit(f)) for f in ("yyyy-MM-dd'T'HH:mm:ssXXX", *formats)]
    return F.coalesce(*tries, text.try_cast("timestamp"))


def nanos_instant(c: str | Column) -> Column:
    """Epoch nanoseconds as an instant."""
    nanos = F.col(c) if isinstance(c, str) else c
    return F.timestamp_micros(F.floor(nanos.cast("decimal(20,0)") / 1000).cast("long"))


def on_hour(left: DataFrame, *rights: DataFrame, how: str = "left", on: Sequence[str] = HOUR) -> DataFrame:
    """Join tables on (date, hour), one after the other: a chain on one key is shuffled once per table."""
    out = left
    for right in rights:
        out = out.join(right, list(on), how)
    return out
