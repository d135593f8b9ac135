"""Registered queries on the smaller operators of the inventory."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.expressions import rounded
from ..operators import incremental, keyed, normalize
from ..sources import bronze
from ..sources.bindings import Silver
from ..sources.shared import folder
from . import forecast, marts, reports, signal
from .oracles import AS_OF, twin
from .staging import Lake

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}
_key = ["date", "hour"]
_told = "SELECT date + 1 AS predicted_date, hour::BIGINT AS hour, smf_try + (hour % 5 - 2) AS predicted_smf FROM smf"


def _add(name: str, plan: Callable[[Lake], DataFrame], body: str | None = None, *exact: str) -> None:
    QUERIES[name] = lambda spark, sf_dir: rounded(plan(Lake(Silver(spark, sf_dir))))
    if body:
        ORACLE_SQL[name] = twin(body, *exact) if exact else twin(body, rounded=False)


def _schema_glob(lake: Lake) -> DataFrame:
    schema = lake.silver.table("events").select("event_id", "event_type").schema
    return bronze.read_bronze(lake.silver.spark, f"{lake.silver.sf_dir}/event*.parquet", schema)


def _files_per_day(lake: Lake) -> DataFrame:
    path, spark = folder(lake.silver.spark), lake.silver.spark
    bronze.write_silver(keyed.day_partitions(lake["idm_transactions"], "date").repartition(6), path)
    written = spark.read.parquet(path).withColumn("file", F.input_file_name())
    return written.groupBy(F.make_date("year", "month", "day").alias("date")).agg(F.count_distinct("file").alias("files"), F.count("*").alias("n"))


def _replaced(lake: Lake) -> DataFrame:
    path = folder(lake.silver.spark)
    for rows in (lake["fx_rates"].where("usdtry > 30"), lake["fx_rates"]):
        incremental.rebuild(rows, path)
    return lake.silver.spark.read.parquet(path)


def _csv(lake: Lake) -> DataFrame:
    path, rows = folder(lake.silver.spark), lake["dams"].select("date", "dam_id", "active_volume")
    rows.write.csv(path, header=True)
    return lake.silver.spark.read.schema(rows.schema).csv(path, header=True)


def _formats(lake: Lake) -> DataFrame:
    at = F.date_trunc("second", "ts")
    text = F.when(F.col("event_id") % 3 == 0, F.date_format(at, "yyyy-MM-dd'T'HH:mm:ssXXX")).when(F.col("event_id") % 3 == 1, F.date_format(at, "dd.MM.yyyy HH:mm:ss")).otherwise(F.date_format(at, "yyyy-MM-dd HH:mm:ss"))
    return lake.silver.events().select("event_id", keyed.parse_instant(text, "dd.MM.yyyy HH:mm:ss").alias("ts"))


def _snapshots(lake: Lake) -> DataFrame:
    rows = lake["participants"].select("organization_id", "organization_name")
    old = rows.select("organization_id", F.lit("old").alias("organization_name"), F.lit("2024-01-01").cast("date").alias("ds"))
    new = rows.where("organization_id % 2 = 0").withColumn("ds", F.lit(AS_OF).cast("date"))
    return normalize.latest_snapshot(old.unionByName(new), "organization_id")


def _cities(lake: Lake) -> DataFrame:
    """Cities one by one, renamed, then as one table."""
    each = [lake.silver["weather"].where(F.col("city") == f"city{i}").select("date", F.lit(n).alias("city"), F.col("temperature_2m").alias("temperature")) for i, n in enumerate(normalize.CITY_WEIGHTS)]
    return reduce(DataFrame.unionByName, [keyed.rename_present(df, {"temperature": "temperature_2m"}) for df in each])


def _guard(lake: Lake) -> DataFrame:
    tables = {"smf": lake["smf"], "none": lake["smf"].where("smf_try < -1e9")}
    return reduce(DataFrame.unionByName, [lake.silver.spark.range(1).select(F.lit(n).alias("source"), F.lit(df.isEmpty()).alias("skipped")) for n, df in tables.items()])


def _predictions(lake: Lake) -> DataFrame:
    path, spark = folder(lake.silver.spark), lake.silver.spark
    told = marts.naive_predictions(lake).select("predicted_date", "hour", "predicted_smf")
    incremental.replace_partitions(told.withColumn("predicted_smf", F.lit(0.0)), path, "predicted_date")
    incremental.upsert(told, path, ["predicted_date", "hour"], "predicted_date")
    return spark.read.parquet(path).select(told.columns)


def _created(lake: Lake) -> DataFrame:
    path, spark = folder(lake.silver.spark), lake.silver.spark
    schema = lake["smf"].schema
    before = incremental.create_if_missing(spark, path, schema).count()
    incremental.upsert(lake["smf"], path, _key)
    after = incremental.create_if_missing(spark, path, schema)
    return after.agg(F.lit(before).cast("long").alias("n_before"), F.count("*").alias("n_after"))


def _results(lake: Lake) -> DataFrame:
    """Result rows by model; a model that is run again replaces its row."""
    rows = lambda names, shift: lake["smf"].groupBy(F.element_at(F.array(*[F.lit(n) for n in names]), F.col("hour") % len(names) + 1).alias("model")).agg((F.avg("smf_try") + shift).alias("score"))
    return incremental.merged(rows(["a", "b", "c"], 0.0), rows(["c", "d"], 1.0), ["model"])


def _stored_backtest(lake: Lake) -> DataFrame:
    path = folder(lake.silver.spark)
    incremental.rebuild(signal.backtest(lake, marts.naive_predictions(lake)), path, "date")
    return lake.silver.spark.read.parquet(path).groupBy("date").agg(F.count("*").alias("n"))


_add("IO3_schema_glob", _schema_glob, "SELECT event_id, event_type FROM events")
_add("IO6_day_partitions", lambda lake: keyed.day_partitions(lake["smf"].select("date", "hour"), "date"), "SELECT date, hour, strftime(date, '%Y') AS year, strftime(date, '%m') AS month, strftime(date, '%d') AS day FROM smf")
_add("IO8_files_per_day", _files_per_day, "SELECT date, 1::BIGINT AS files, count(*) AS n FROM idm_transactions GROUP BY 1")
_add("IO17_replaced_table", _replaced, "SELECT * FROM fx_rates", "date", "is_ffilled")
_add("IO18_csv_export", _csv, "SELECT date, dam_id, active_volume FROM dams", "date", "dam_id")
_add("NO2_formats", _formats, "SELECT event_id, date_trunc('second', ts) AS ts FROM events")
_add("NO5_cast_present", lambda lake: keyed.cast_present(lake.silver.table("orders").select("o_orderkey", F.col("o_totalprice").cast("string").alias("price"), "o_orderstatus"), {"price": "double", "o_orderstatus": "long", "absent": "long"}), "SELECT o_orderkey, o_totalprice AS price, NULL::BIGINT AS o_orderstatus FROM orders", "o_orderkey", "o_orderstatus")
_add("NO6_rename_present", lambda lake: keyed.rename_present(lake.silver.table("supplier").select("s_suppkey", "s_name"), {"s_name": "orgName", "absent": "x"}), "SELECT s_suppkey, s_name AS \"orgName\" FROM supplier")
_add("NO9_lead_source", lambda lake: normalize.lead_source(lake["interim_mcp"].select(*_key), AS_OF), f"SELECT date, hour, DATE '{AS_OF}' + 1 AS content_date FROM interim_mcp")
_add("NO11_latest_snapshot", _snapshots, f"SELECT organization_id, CASE WHEN organization_id % 2 = 0 THEN organization_name ELSE 'old' END AS organization_name, CASE WHEN organization_id % 2 = 0 THEN DATE '{AS_OF}' ELSE DATE '2024-01-01' END AS ds FROM participants")
_add("NO12_outage_instants", lambda lake: bronze.normalise(lake.silver["outages"].drop("_record_hash").withColumns({c: F.date_format(c, "yyyy-MM-dd'T'HH:mm:ssXXX") for c in ("caseStartDate", "caseEndDate")}), bronze.JOBS["outages"]).select("id", "year", "month", "day").distinct(), "SELECT id::BIGINT AS id, strftime(start_time, '%Y') AS year, strftime(start_time, '%m') AS month, strftime(start_time, '%d') AS day FROM outages")
_add("NO19_renamed_cities", _cities, "SELECT (date::TIMESTAMP + hour * INTERVAL 1 HOUR - INTERVAL 3 HOUR) AS date, CASE city_name WHEN 'city0' THEN 'istanbul' WHEN 'city1' THEN 'izmir' WHEN 'city2' THEN 'konya' ELSE 'ankara' END AS city, temperature_celsius AS temperature_2m FROM weather", "date", "city")
_add("NO20_empty_guard", _guard, "SELECT 'smf' AS source, count(*) = 0 AS skipped FROM smf UNION ALL SELECT 'none', count(*) FILTER (false) = 0 FROM smf")
_add("IN6_predictions", _predictions, _told, "predicted_date", "hour")
_add("IN8_create_if_missing", _created, "SELECT 0::BIGINT AS n_before, count(*) AS n_after FROM smf")
_add("IN10_result_rows", _results, "WITH o AS (SELECT ['a', 'b', 'c'][hour % 3 + 1] AS model, avg(smf_try) AS score FROM smf GROUP BY 1), n AS (SELECT ['c', 'd'][hour % 2 + 1] AS model, avg(smf_try) + 1 AS score FROM smf GROUP BY 1) SELECT * FROM n UNION ALL SELECT * FROM o WHERE model NOT IN (SELECT model FROM n)", "model")
_add("ML2_lag_features", lambda lake: marts.lag_features(lake["smf"].join(lake["system_direction"], _key, "left")), "SELECT date, hour, smf_try, system_direction, lag(smf_try, 5) OVER o AS smf_try_lag_5h, lag(smf_try, 24) OVER o AS smf_try_lag_24h, lag(smf_try, 168) OVER o AS smf_try_lag_168h, avg(smf_try) OVER d AS smf_rolling_avg_24h, max(smf_try) OVER d AS smf_rolling_max_24h, min(smf_try) OVER d AS smf_rolling_min_24h, avg(smf_try) OVER w AS smf_rolling_avg_168h, lag(system_direction, 5) OVER o AS system_direction_lag_5h FROM smf LEFT JOIN system_direction USING (date, hour) WINDOW o AS (ORDER BY date, hour), d AS (ORDER BY date, hour ROWS BETWEEN 24 PRECEDING AND 1 PRECEDING), w AS (ORDER BY date, hour ROWS BETWEEN 168 PRECEDING AND 1 PRECEDING)", "date", "hour", "system_direction", "system_direction_lag_5h")
_add("ML22_aligned", lambda lake: forecast.aligned(lake["pricing"], ["ptf_usd", "absent", "ptf_try"], _key), "SELECT date, hour, coalesce(ptf_usd, 0) AS ptf_usd, 0.0::DOUBLE AS absent, ptf_try FROM pricing", "date", "hour")
_add("TS7_stored_backtest", _stored_backtest)
_add("BI6_spread_histogram", lambda lake: reports.histogram(marts.cross_market_spread(lake), "smf_gop_spread_try", 25.0), "SELECT floor((smf_try - ptf_try) / 25) * 25 AS bin, count(*) AS n FROM pricing JOIN smf USING (date, hour) WHERE smf_try - ptf_try IS NOT NULL GROUP BY 1", "n")
