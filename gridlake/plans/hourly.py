"""Hourly tables side by side: dedup of many staged tables and their join on (date, hour) as one aggregate.

Staged tables of one row an hour share their key, so instead of a window and a shuffle for each, silver rows meet once at
their market hour, where each table's rows are settled among themselves. What is read more than once is written bucketed
and sorted by (date, hour), so that later joins on the hour read aligned files without an exchange.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.keyed import HOUR
from ..sources.shared import folder
from .staging import MODELS, Lake, Model, time_columns, typed_columns

#: Hours are 8,766 a year whatever is traded; ten years give each bucket 11,000 rows.
BUCKETS = 8


def _inside(source: str) -> Callable[[str], Column]:
    return lambda c: F.col(f"{source}.{c}")


def _settled(model: Model, have: list[str], here: Column) -> Column:
    """The staged row of an hour as a struct, null where the table has none; the rule is that of ``staging.stage``."""
    at = _inside(model.source)
    typed = {n: c for n, c in typed_columns(model, at).items() if n not in model.key}
    if model.fold:
        fold = F.avg if model.fold == "avg" else F.sum
        return F.when(F.bool_or(here), F.struct(*[fold(F.when(here, c)).alias(n) for n, c in typed.items()]))
    last = [at(c) for c in (model.latest, "_record_hash") if c in have]
    order = F.struct(*last, F.xxhash64(*typed.values()))
    return F.max_by(F.struct(*[c.alias(n) for n, c in typed.items()]), F.when(here, order))


def market_hours(lake: Lake, *names: str) -> DataFrame:
    """One row per market hour, with a struct for each of the staged tables ``names`` (null where it lacks the hour)."""
    sources = list(dict.fromkeys(MODELS[n].source for n in names))
    rows = lake.silver.side_by_side(sources)
    keys = {n: F.when(F.col(MODELS[n].source).isNotNull(), F.struct(*[c.alias(k) for k, c in time_columns(MODELS[n], _inside(MODELS[n].source)).items()])) for n in names}
    # Tables may place one row at different hours (a UTC day beside a local one): the row goes to each of them.
    met = rows.select("*", F.explode(F.array_distinct(F.array_compact(F.array(*keys.values())))).alias("_k"))
    dealt = met.repartition(BUCKETS, "_k.date", "_k.hour")
    each = [_settled(MODELS[n], rows.schema[MODELS[n].source].dataType.names, keys[n].eqNullSafe(F.col("_k"))).alias(n) for n in names]
    return dealt.groupBy(F.col("_k.date").alias("date"), F.col("_k.hour").alias("hour")).agg(*each)


def trade_hours(lake: Lake) -> DataFrame:
    """Hourly figures of intraday trades, and the number and summed mean price of the contracts traded."""
    price, quantity = F.col("price_try"), F.col("quantity_mwh")
    by_contract = lake["idm_transactions"].groupBy(*HOUR, "contract_name").agg(
        F.sum(price * quantity).alias("worth"), F.sum(price).alias("prices"), F.count(price).alias("priced"), F.sum(quantity).alias("volume"),
        F.count("id").alias("n"), F.min(price).alias("low"), F.max(price).alias("high"), F.avg(price).alias("mean"),
    )
    return by_contract.repartition(BUCKETS, *HOUR).groupBy(*HOUR).agg(
        F.try_divide(F.sum("worth"), F.sum("volume")).alias("gip_vwap_try"), F.try_divide(F.sum("prices"), F.sum("priced")).alias("gip_avg_price_try"), F.sum("volume").alias("gip_total_volume_mwh"), F.sum("n").alias("gip_transaction_count"),
        F.min("low").alias("gip_min_price_try"), F.max("high").alias("gip_max_price_try"), (F.max("high") - F.min("low")).alias("gip_price_range_try"), F.sum("mean").alias("contract_means"), F.count("mean").alias("contracts"),
    )


def bucketed(df: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """The table written in buckets of (date, hour), sorted in them, in the shared folder."""
    spark, name = df.sparkSession, f"hours_{uuid.uuid4().hex}"
    df.write.format("parquet").bucketBy(buckets, *HOUR).sortBy(*HOUR).option("path", folder(spark)).saveAsTable(name)
    return spark.table(name)


def at_once(*builds: Callable[[], DataFrame]) -> list[DataFrame]:
    """Tables whose jobs don't depend on each other, built side by side."""
    with ThreadPoolExecutor(len(builds)) as pool:
        return [f.result() for f in [pool.submit(b) for b in builds]]
