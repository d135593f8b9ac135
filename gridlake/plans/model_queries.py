"""Registered queries on features, models and streams. Models and streams have no SQL twin but where a figure is exact."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.expressions import DEFICIT, instant_of, rounded
from ..operators import incremental
from ..sources.bindings import Silver
from ..sources.shared import folder
from ..streaming import market as streams
from . import forecast, marts
from .oracles import AS_OF, twin
from .staging import Lake

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def _add(name: str, plan: Callable[[Lake], DataFrame], body: str | None = None, *exact: str) -> None:
    QUERIES[name] = lambda spark, sf_dir: rounded(plan(Lake(Silver(spark, sf_dir))))
    if body:
        ORACLE_SQL[name] = twin(body, *exact) if exact else twin(body, rounded=False)


def _rows(lake: Lake) -> DataFrame:
    """The feature table, written once: models read it many times."""
    path = folder(lake.silver.spark)
    forecast.feature_table(lake, AS_OF).write.parquet(path)
    return lake.silver.spark.read.parquet(path)


def _boosted(rows: DataFrame, days: int = 7) -> DataFrame:
    past, held = forecast.time_holdout(rows, days)
    return forecast.score_boosted(forecast.fit_boosted(past), held)


def _beats(rows: DataFrame, days: int = 7) -> DataFrame:
    """Accuracy and macro F1 on the last days of boosting, the forest and yesterday's class."""
    past, held = forecast.time_holdout(rows, days)
    yesterday = rows.select(F.date_add("date", 1).alias("date"), "hour", F.col("system_direction").alias("predicted_direction"))
    told = {"boosted": _boosted(rows, days), "forest": forecast.score_direction(forecast.fit_direction(past), held), "yesterday": held.join(yesterday, ["date", "hour"])}
    one = lambda name, scored: scored.agg(F.avg((F.col("predicted_direction") == F.col("system_direction")).cast("double")).alias("accuracy")).crossJoin(forecast.class_metrics(scored).agg(F.avg("f1").alias("macro_f1"))).select(F.lit(name).alias("model"), "accuracy", "macro_f1")
    return reduce(DataFrame.unionByName, [one(n, s) for n, s in told.items()])


def _stored(lake: Lake) -> DataFrame:
    """Both stages fitted and kept, loaded again and applied to the last days."""
    rows, path = _rows(lake), folder(lake.silver.spark)
    forecast.store_two_stage(rows, path)
    return forecast.score_stored(forecast.time_holdout(rows, 7)[1], path)


def _forward_stored(lake: Lake) -> DataFrame:
    """Hours to come, scored by the models that are kept."""
    path = folder(lake.silver.spark)
    forecast.store_two_stage(_rows(lake), path)
    return forecast.score_stored(forecast.forward_rows(lake, "2024-01-20"), path)


def _scored(lake: Lake) -> DataFrame:
    return forecast.two_stage(_rows(lake))


def _naive(lake: Lake) -> DataFrame:
    """Naive predictions beside what happened."""
    told = marts.naive_predictions(lake).select(F.col("predicted_date").alias("date"), F.col("hour").cast("int").alias("hour"), "predicted_smf", "predicted_direction", *forecast.PROBABILITIES)
    return told.join(lake["smf"], ["date", "hour"]).join(lake["system_direction"], ["date", "hour"], "left")


_told = "(SELECT date + 1 AS date, hour, smf_try + (hour % 5 - 2) AS p, CASE WHEN hour % 5 - 2 > 0 THEN 'ENERGY_DEFICIT' WHEN hour % 5 - 2 < 0 THEN 'ENERGY_SURPLUS' ELSE 'IN_BALANCE' END AS d, CASE WHEN hour % 5 - 2 > 0 THEN 0.6 WHEN hour % 5 - 2 < 0 THEN 0.3 ELSE 0.2 END AS pd FROM smf)"
_seen = f"(SELECT * FROM {_told} JOIN smf USING (date, hour) LEFT JOIN system_direction USING (date, hour))"
_class = " UNION ALL ".join(f"SELECT '{c}' AS class, count(*) FILTER (system_direction = '{c}' AND d = '{c}') AS tp, count(*) FILTER (system_direction <> '{c}' AND d = '{c}') AS fp, count(*) FILTER (system_direction = '{c}' AND d <> '{c}') AS fn, count(*) FILTER (system_direction <> '{c}' AND d <> '{c}') AS tn FROM {_seen}" for c in forecast.CLASSES)

_add("ML1_calendar_features", lambda lake: forecast.calendar_features(lake["pricing"].select("date", "hour")), "SELECT date, hour, sin(2 * pi() * hour / 24) AS hour_sin, cos(2 * pi() * hour / 24) AS hour_cos, (isodow(date) - 1)::INT AS day_of_week, month(date)::INT AS month, (isodow(date) > 5)::INT AS is_weekend, ((month(date), day(date)) IN ((1, 1), (4, 23), (5, 1), (5, 19), (7, 15), (8, 30), (10, 29)))::INT AS is_holiday FROM pricing", "date", "hour", "day_of_week", "month", "is_weekend", "is_holiday")
_add("ML3_direction_flags", lambda lake: forecast.direction_flags(lake["system_direction"], "system_direction"), "SELECT *, (system_direction = 'ENERGY_DEFICIT')::INT AS direction_lag5h_energy_deficit, (system_direction = 'ENERGY_SURPLUS')::INT AS direction_lag5h_energy_surplus, (system_direction = 'IN_BALANCE')::INT AS direction_lag5h_in_balance FROM system_direction")
_add("ML4_filled_shocks", lambda lake: forecast.filled_shocks(lake["load_estimation"].select("date", "hour").join(lake["smf"].withColumnRenamed("smf_try", "shock"), ["date", "hour"], "left"), ["shock"]), "WITH j AS (SELECT date, hour, coalesce(last_value(smf_try IGNORE NULLS) OVER (ORDER BY date, hour), 0) AS shock FROM load_estimation LEFT JOIN smf USING (date, hour)) SELECT *, avg(shock) OVER (ORDER BY date, hour ROWS BETWEEN 167 PRECEDING AND CURRENT ROW) AS supply_shock_trend_7d FROM j", "date", "hour")
_add("ML5_feature_table", lambda lake: forecast.feature_table(lake, AS_OF))
_add("ML6_weights", lambda lake: forecast.weighted(lake["system_direction"]).select("date", "hour", "weight"), "SELECT date, hour, 0.5 ** ((max(date) OVER () - date) / 90.0) * count(*) OVER () / (3 * count(*) OVER (PARTITION BY system_direction)) AS weight FROM system_direction", "date", "hour")
_add("ML7_time_holdout", lambda lake: forecast.time_holdout(lake["smf"], 7)[1], "SELECT * FROM smf WHERE date > (SELECT max(date) - 7 FROM smf)", "date", "hour")
_add("ML8_time_folds", lambda lake: forecast.with_folds(lake["smf"]).groupBy("fold").agg(F.count("*").alias("n"), F.min("date").alias("first"), F.max("date").alias("last")), "WITH e AS (SELECT quantile_cont(date - DATE '1970-01-01', [0.25, 0.5, 0.75]) AS q FROM smf) SELECT (1 + len(list_filter(q, lambda x: x < date - DATE '1970-01-01')))::INT AS fold, count(*) AS n, min(date) AS first, max(date) AS last FROM smf, e GROUP BY 1")
_add("ML9_direction", lambda lake: (lambda rows: forecast.score_direction(forecast.fit_direction(forecast.time_holdout(rows, 7)[0]), forecast.time_holdout(rows, 7)[1]).select("date", "hour", "system_direction", "predicted_direction", *forecast.PROBABILITIES))(_rows(lake)))
_add("ML9_boosted_direction", lambda lake: _boosted(_rows(lake)).select("date", "hour", "system_direction", "predicted_direction", *forecast.PROBABILITIES))
_add("ML9_beats_naive", lambda lake: _beats(_rows(lake)))
_add("ML10_out_of_fold", lambda lake: forecast.out_of_fold(_rows(lake)).select("date", "hour", "fold", *forecast.PROBABILITIES))
_add("ML11_two_stage", lambda lake: _scored(lake).select("date", "hour", "smf_try", "predicted_smf", "predicted_direction"))
_add("ML11_early_stopping", lambda lake: forecast.early_stopping(_rows(lake)))
_add("ML12_race", lambda lake: forecast.race(_rows(lake), [{"trees": 3, "depth": 2}, {"trees": 5, "depth": 3}, {"trees": 10, "depth": 3}, {"trees": 10, "depth": 5}], folds=3))
_add("ML12_search", lambda lake: forecast.search(_rows(lake), [{"trees": 5, "depth": 3}, {"trees": 10, "depth": 5}], folds=2))
_add("ML13_regression_metrics", lambda lake: forecast.regression_metrics(_naive(lake), lake["smf"]), f"SELECT count(*) AS n, avg(abs(p - smf_try)) AS mae, avg(p - smf_try) AS bias, sqrt(avg((p - smf_try) ** 2)) AS rmse, avg(abs(p - smf_try) / nullif((abs(p) + abs(smf_try)) / 2, 0)) * 100 AS smape, avg(abs(smf_try - b)) AS naive_mae, avg(abs(p - smf_try)) FILTER (b IS NOT NULL) / nullif(avg(abs(smf_try - b)), 0) AS mase FROM {_seen} LEFT JOIN (SELECT date + 1 AS date, hour, smf_try AS b FROM smf) USING (date, hour)", "n")
_add("ML14_class_metrics", lambda lake: forecast.class_metrics(_naive(lake)), f"SELECT *, coalesce(tp / nullif(tp + fp, 0), 0) AS precision, coalesce(tp / nullif(tp + fn, 0), 0) AS recall, coalesce(2 * (tp / nullif(tp + fp, 0)) * (tp / nullif(tp + fn, 0)) / nullif(tp / nullif(tp + fp, 0) + tp / nullif(tp + fn, 0), 0), 0) AS f1 FROM ({_class})", "class", "tp", "fp", "fn", "tn")
_add("ML15_rank_auc", lambda lake: forecast.rank_auc(_naive(lake).where("system_direction IS NOT NULL"), "proba_energy_deficit", F.col("system_direction") == DEFICIT), f"WITH s AS (SELECT pd, system_direction = 'ENERGY_DEFICIT' AS y FROM {_seen} WHERE system_direction IS NOT NULL), r AS (SELECT y, rank() OVER (ORDER BY pd) + (count(*) OVER (PARTITION BY pd) - 1) / 2.0 AS k FROM s) SELECT 1 AS one, (sum(k) FILTER (y) - count(*) FILTER (y) * (count(*) FILTER (y) + 1) / 2.0) / nullif(count(*) FILTER (y) * count(*) FILTER (NOT y), 0) AS auc FROM r", "one")
ORACLE_SQL["ML15_rank_auc"] = f"SELECT * EXCLUDE (one) FROM ({ORACLE_SQL['ML15_rank_auc']})"
_add("ML16_naive_accuracy", lambda lake: forecast.naive_accuracy(lake["system_direction"]), "SELECT count(*) AS n, avg((a.system_direction = b.system_direction)::INT) AS accuracy FROM system_direction a JOIN system_direction b ON a.date = b.date + 1 AND a.hour = b.hour", "n")
_add("ML17_importances", lambda lake: forecast.importances(forecast.fit_direction(_rows(lake)), lake.silver.spark))


def _backtest(lake: Lake) -> DataFrame:
    """Write half of the scored rows, then what is newer than the last written; twice."""
    spark, path, where = lake.silver.spark, folder(lake.silver.spark), folder(lake.silver.spark)
    forecast.prediction_rows(_scored(lake), f"{AS_OF} 00:00:00").write.parquet(path)
    rows = spark.read.parquet(path)
    first = rows.where("day(predicted_date) % 2 = 0 AND predicted_date < DATE '2024-01-28'")
    incremental.upsert(first, where, ["predicted_date", "hour"], "predicted_date")
    for _ in range(2):
        news = forecast.unscored(rows.withColumnRenamed("predicted_date", "date"), spark.read.parquet(where)).withColumnRenamed("date", "predicted_date")
        incremental.upsert(news.select(rows.columns), where, ["predicted_date", "hour"], "predicted_date")
    return spark.read.parquet(where).select("predicted_date", "hour", "predicted_smf", "predicted_direction")


_add("ML18_backtest_scoring", _backtest)
_add("ML18_stored_models", lambda lake: _stored(lake).select("date", "hour", "smf_try", "predicted_smf", "predicted_direction", "model_version"))
_add("ML19_stored_forward", lambda lake: _forward_stored(lake).select("date", "hour", "lead_hours", "predicted_smf", "predicted_direction", *forecast.PROBABILITIES))
_add("ML19_forward_rows", lambda lake: forecast.forward_rows(lake, "2024-01-20"))
_add("ML20_horizon_snapshot", lambda lake: forecast.horizon_snapshot(forecast.forward_rows(lake, "2024-01-20")).select("date", "hour", "lead_hours"))
_add("ML21_comparison", lambda lake: forecast.comparison(_rows(lake), {"small": {"trees": 5, "depth": 3}, "large": {"trees": 20, "depth": 5}}))
_add("ML23_enough_history", lambda lake: lake.silver.spark.range(1).select(F.lit(forecast.enough_history(lake["smf"])).alias("enough")), f"SELECT count(*) >= {forecast.MIN_ROWS} AS enough FROM smf")


def _stream(lake: Lake, table: DataFrame, parts: int = 1) -> DataFrame:
    """A table as a file stream."""
    path, spark = folder(lake.silver.spark), lake.silver.spark
    table.repartition(parts).write.parquet(path)
    return spark.readStream.schema(table.schema).parquet(path)


def _drained(lake: Lake, stream: DataFrame) -> DataFrame:
    return streams.drained(stream, folder(lake.silver.spark), folder(lake.silver.spark))


def _trades(lake: Lake) -> DataFrame:
    return lake.silver["idm_transactions"].select("id", F.col("date").alias("ts"), F.col("price").alias("price_try"), F.col("quantity").alias("quantity_mwh"))


def _vwap(lake: Lake) -> DataFrame:
    """Trades, and one far ahead, so that the watermark passes every real hour."""
    end = lake.silver.spark.range(1).select(F.lit(-1).cast("long").alias("id"), F.lit("2030-01-01").cast("timestamp").alias("ts"), F.lit(0.0).alias("price_try"), F.lit(0.0).alias("quantity_mwh"))
    return _drained(lake, streams.hourly_vwap(_stream(lake, _trades(lake).unionByName(end)), "60 days"))


def _late(lake: Lake) -> DataFrame:
    """Corrections reach the table in a stream."""
    path, spark = folder(lake.silver.spark), lake.silver.spark
    incremental.replace_partitions(lake["smf"], path)
    news = lake["smf"].where("date >= DATE '2024-01-25'").select("date", "hour", (F.col("smf_try") + 3).alias("smf_try"))
    both = news.withColumns({"arrived": F.lit(1), "smf_try": F.lit(0.0)}).unionByName(news.withColumn("arrived", F.lit(2)))
    incremental.rebuild(spark.read.parquet(path).withColumn("arrived", F.lit(0)), f"{path}-a", "date")
    streams.upsert_stream(_stream(lake, both), f"{path}-a", ["date", "hour"], folder(spark)).awaitTermination()
    return spark.read.parquet(f"{path}-a").select("date", "hour", "smf_try")


def _first_prediction(lake: Lake) -> DataFrame:
    path, spark, told = folder(lake.silver.spark), lake.silver.spark, marts.naive_predictions(lake).select("predicted_date", "hour", "predicted_smf")
    for shift in (0.0, 100.0):
        streams.snapshot_stream(_stream(lake, told.withColumn("predicted_smf", F.col("predicted_smf") + shift)), path, ["predicted_date", "hour"], folder(spark)).awaitTermination()
    return spark.read.parquet(path).select("predicted_date", "hour", "predicted_smf")


def _in_batches(lake: Lake, *tables: DataFrame) -> DataFrame:
    """Tables as a stream that takes one of them a batch, in their order."""
    path, spark = folder(lake.silver.spark), lake.silver.spark
    for table in tables:
        table.coalesce(1).write.mode("append").parquet(path)
    return spark.readStream.schema(tables[0].schema).option("maxFilesPerTrigger", 1).parquet(path)


def _keyed_corrections(lake: Lake) -> DataFrame:
    """The newest correction comes first, an older one in a later batch."""
    path, spark = folder(lake.silver.spark), lake.silver.spark
    incremental.rebuild(lake["smf"].withColumn("arrived", F.lit(0)), path, "date")
    news = lake["smf"].where("date >= DATE '2024-01-25'").withColumn("at", instant_of())
    told = [news.withColumns({"smf_try": price, "arrived": F.lit(n)}) for n, price in ((2, F.col("smf_try") + 3), (1, F.lit(0.0)))]
    streams.keyed_upsert_stream(_in_batches(lake, *told), path, ["date", "hour"], folder(spark)).awaitTermination()
    return spark.read.parquet(path).select("date", "hour", "smf_try")


def _keyed_predictions(lake: Lake) -> DataFrame:
    told = marts.naive_predictions(lake).select("predicted_date", "hour", "predicted_smf", instant_of("predicted_date").alias("at"))
    batches = [told.withColumns({"predicted_smf": F.col("predicted_smf") + 100.0 * n, "told": F.lit(n)}) for n in range(2)]
    return _drained(lake, streams.first_predictions(_in_batches(lake, *batches), ["predicted_date", "hour"], "told")).select("predicted_date", "hour", "predicted_smf")


_add("SS3_keyed_corrections", _keyed_corrections, "SELECT date, hour, smf_try + CASE WHEN date >= DATE '2024-01-25' THEN 3 ELSE 0 END AS smf_try FROM smf", "date", "hour")
_add("SS4_keyed_predictions", _keyed_predictions, f"SELECT date AS predicted_date, hour::BIGINT AS hour, p AS predicted_smf FROM {_told}", "predicted_date", "hour")
_add("SS1_hourly_vwap", _vwap, "SELECT (came + INTERVAL 3 HOUR)::DATE AS date, hour(came + INTERVAL 3 HOUR)::INT AS hour, sum(p * q) / nullif(sum(q), 0) AS gip_vwap_try, sum(q)::DOUBLE AS gip_volume_mwh, count(*) AS gip_transaction_count FROM (SELECT date_trunc('hour', c) AS came, p, q FROM (SELECT ts AS c, value AS p, 1 + k % 10 AS q FROM ev UNION ALL SELECT ts + INTERVAL 1 HOUR, value, 1 + k % 10 FROM ev WHERE event_id % 10 = 0)) GROUP BY 1, 2", "date", "hour", "gip_transaction_count")
_add("SS2_once_by_id", lambda lake: _drained(lake, streams.once_by_id(_stream(lake, _trades(lake)), "60 days")).select("id"), "SELECT event_id AS id FROM events")
_add("SS3_late_corrections", _late, "SELECT date, hour, smf_try + CASE WHEN date >= DATE '2024-01-25' THEN 3 ELSE 0 END AS smf_try FROM smf", "date", "hour")
_add("SS4_first_prediction", _first_prediction, f"SELECT date AS predicted_date, hour::BIGINT AS hour, p AS predicted_smf FROM {_told}", "predicted_date", "hour")
