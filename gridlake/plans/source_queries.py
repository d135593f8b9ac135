"""Registered queries on sources, normalisation and incremental writes: tables are written, changed and read back."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.expressions import rounded
from ..operators import incremental, keyed, normalize
from ..sources import bronze
from ..sources.bindings import GENERATION_FUELS, PLAN_FUELS, UNLICENSED, YEARS_ON, Silver
from ..sources.shared import folder
from . import marts, staging
from .oracles import AS_OF, twin
from .staging import GENERATION, Lake

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def _add(name: str, plan: Callable[[Lake], DataFrame], body: str | None = None, *exact: str) -> None:
    QUERIES[name] = lambda spark, sf_dir: rounded(plan(Lake(Silver(spark, sf_dir))))
    if body:
        ORACLE_SQL[name] = twin(body, *exact) if exact else twin(body, rounded=False)


def raw(lake: Lake, source: str) -> DataFrame:
    """A silver binding as it would land: instants as text with offset, every row twice."""
    job, df = bronze.JOBS[source], lake.silver[source].drop("_record_hash")
    df = df.withColumns({c: F.date_format(c, "yyyy-MM-dd'T'HH:mm:ssXXX") for c in job.instants if c in df.columns})
    return df.unionByName(df)


def _silver_job(source: str) -> Callable[[Lake], DataFrame]:
    run_date = AS_OF if bronze.JOBS[source].snapshot or bronze.JOBS[source].lead_days else None
    return lambda lake: bronze.normalise(raw(lake, source), bronze.JOBS[source], run_date)


#: Twins of the jobs. Where a key has several rows, the greatest stays by its other columns in their order, nulls last.
_at, _day = "strftime(date, '%Y-%m-%d %H:%M:%S')", "strftime(date, '%Y') AS year, strftime(date, '%m') AS month, strftime(date, '%d') AS day"
_run_day = f"'{AS_OF[:4]}' AS year, '{AS_OF[5:7]}' AS month, '{AS_OF[8:]}' AS day"
_clock = "lpad(hour::VARCHAR, 2, '0') || ':00'"
_sbfgp = ", ".join([f"every * 1.05 AS toplam, {', '.join(f'band{i} * 1.05 AS ' + chr(34) + f + chr(34) for i, f in enumerate(PLAN_FUELS))}"])
SILVER_TWINS: dict[str, tuple[str, ...]] = {
    "interim_mcp": (f"SELECT t AS date, {_clock} AS hour, {_clock} AS time, coalesce(avg_view, avg_purchase, 50.0) * 1.01 AS \"marketTradePrice\", DATE '{AS_OF}' + 1 AS content_date, md5(strftime(t, '%Y-%m-%d %H:%M:%S') || '||' || {_clock}) AS _record_hash, {_run_day} FROM slv WHERE sum_click IS NOT NULL AND parity = 0", "date", "hour", "time", "content_date", "_record_hash", "year", "month", "day"),
    "idm_transactions": (f"SELECT event_id AS id, date, event_type AS \"contractName\", value AS price, (1 + k % 10)::DOUBLE AS quantity, lpad(hour(date + INTERVAL 3 HOUR)::VARCHAR, 2, '0') || ':00' AS hour, md5({_at} || '||' || event_type || '||' || event_id) AS _record_hash, {_day} FROM (SELECT event_id, event_type, value, k, date_trunc('second', came) AS date FROM (SELECT *, ts AS came FROM ev UNION ALL SELECT *, ts + INTERVAL 1 HOUR FROM ev WHERE event_id % 10 = 0))", "id", "date", "\"contractName\"", "hour", "_record_hash", "year", "month", "day"),
    "sbfgp": (f"SELECT date, hour, time, {_sbfgp}, md5({_at} || '||' || time) AS _record_hash, {_day} FROM (SELECT * EXCLUDE (date, hour), t AS date, {_clock} AS hour, {_clock} AS time FROM slv WHERE parity = 1)", "date", "hour", "time", "_record_hash", "year", "month", "day"),
    "dams": (f"SELECT date, dam_id AS \"damId\", basin_name AS \"basinName\", dam_name AS \"damName\", active_volume AS \"activeVolume\", md5({_at} || '||' || dam_id) AS _record_hash, {_day} FROM (SELECT * REPLACE (date::TIMESTAMP AS date) FROM dams)", "date", "\"damId\"", "\"basinName\"", "\"damName\"", "_record_hash", "year", "month", "day"),
    "weather": (f"SELECT date, city, temperature_2m, wind_speed_10m, shortwave_radiation, relative_humidity_2m, md5({_at} || '||' || city) AS _record_hash, {_day} FROM (SELECT date_trunc('hour', ts) AS date, 'city' || (user_id % 4) AS city, avg(value) AS temperature_2m, max(value) AS wind_speed_10m, sum(value) AS shortwave_radiation, min(value) AS relative_humidity_2m FROM ev GROUP BY 1, 2)", "date", "city", "_record_hash", "year", "month", "day"),
    "fx_rates": (f"SELECT date, usdtry, is_ffilled, 'orders' AS source, md5(strftime(date, '%Y-%m-%d')) AS _record_hash, {_day} FROM fx_rates", "date", "is_ffilled", "source", "_record_hash", "year", "month", "day"),
    "participants": (f"SELECT organization_id::BIGINT AS id, organization_name AS \"orgName\", organization_code AS \"orgCode\", eic_code AS \"eicCode\", legal_status AS \"legalStatus\", DATE '{AS_OF}' AS ds, md5(organization_id::BIGINT::VARCHAR) AS _record_hash, {_run_day} FROM participants",),
}


def _named(columns: dict[str, str]) -> str:
    return ", ".join(f'{c} AS "{n}"' for n, c in columns.items())


def _silver_twin(rows: str, columns: list[str], keys: list[str], exact: list[str], hashed: str) -> tuple[str, ...]:
    """One row for each key of ``rows``, with record hash and day."""
    order = ", ".join(f'"{c}" DESC NULLS LAST' for c in columns if c not in keys)
    kept = f"SELECT * FROM ({rows}) QUALIFY row_number() OVER (PARTITION BY {', '.join(f'"{k}"' for k in keys)} ORDER BY {order}) = 1"
    quoted = lambda names: [f'"{c}"' for c in names]
    return (f"SELECT {', '.join(quoted(columns))}, md5({hashed}) AS _record_hash, {_day} FROM ({kept})", *quoted(exact), "_record_hash", "year", "month", "day")


def _hour_twin(condition: str, columns: dict[str, str], keys: list[str], hashed: str = _at, text: tuple[str, ...] = ()) -> tuple[str, ...]:
    rows = f"SELECT t AS date, {_clock} AS hour, {_clock} AS time, {_named(columns)} FROM slv WHERE {condition}"
    return _silver_twin(rows, ["date", "hour", "time", *columns], keys, ["date", "hour", "time", *text], hashed)


def _bands(fuels: list[str], factor: str, total: str = "toplam") -> dict[str, str]:
    return {total: f"every * {factor}", **{f: f"band{i} * {factor}" for i, f in enumerate(fuels)}}


def _order_columns(kind: str, side: str) -> dict[str, str]:
    coded = {f"{side}Regulation{n}Coded": f"{kind}{i}" for i, n in enumerate(("Zero", "One", "Two"))}
    return {**coded, f"{side}RegulationDelivered": f"sum_{kind} * 0.8", "net": f"sum_{kind} - every * 0.1"}


_zero = lambda *kinds: " + ".join(f"coalesce(sum_{k}, 0)" for k in kinds)
_made, _used = _zero("click", "signup"), _zero("view", "purchase")
_net = f"round(coalesce(sum_click, 0) + coalesce(sum_signup, 0) - coalesce(sum_view, 0) - coalesce(sum_purchase, 0), 3)"  # noqa: F541
_by_hour, _by_time = f"{_at} || '||' || hour", f"{_at} || '||' || time"
_line_at = f"l_shipdate + INTERVAL {YEARS_ON} YEAR + ((l_partkey % 24) - 3) * INTERVAL 1 HOUR AS date, lpad((l_partkey % 24)::VARCHAR, 2, '0') || ':00'"
_lines_from = "FROM lineitem JOIN supplier ON l_suppkey = s_suppkey"
_by_org = f"SELECT {_line_at} AS hour, l_suppkey AS \"organizationId\", s_name AS \"organizationName\", CASE WHEN l_returnflag = 'A' THEN l_quantity ELSE 0 END AS \"matchedBids\", CASE WHEN l_returnflag = 'A' THEN 0 ELSE l_quantity END AS \"matchedOffers\" {_lines_from}"
_fuel_of_line = {f: f"CASE WHEN l_linenumber % {len(PLAN_FUELS)} = {i} THEN l_quantity ELSE 0 END" for i, f in enumerate(PLAN_FUELS)}
_kgup_rows = f"SELECT {_line_at} AS time, l_suppkey AS \"orgId\", l_partkey AS \"uevcbId\", 'unit' || l_partkey AS \"uevcbName\", {_named({'toplam': 'l_quantity', **_fuel_of_line})} {_lines_from}"
_outage_rows = f"SELECT l_orderkey * 10 + l_linenumber AS id, o_orderdate + INTERVAL {YEARS_ON} YEAR AS \"caseStartDate\", least(l_shipdate + INTERVAL {YEARS_ON} YEAR, o_orderdate + INTERVAL {YEARS_ON} YEAR + INTERVAL 30 DAY) AS \"caseEndDate\", 'org' || l_suppkey AS \"orgName\", 'plant' || l_partkey AS \"powerPlantName\", l_quantity * 2 AS \"operatorPower\", l_quantity AS \"capacityAtCaseTime\", 'reason' || l_linenumber AS reason FROM lineitem JOIN orders ON l_orderkey = o_orderkey"
_curve_rows = "SELECT TIMESTAMP '2023-12-31 21:00:00' + (p_partkey % 30) * INTERVAL 1 DAY + (p_size % 24) * INTERVAL 1 HOUR AS date, p_retailprice AS price, p_size * 10.0::DOUBLE AS supply, 600.0::DOUBLE - p_size * 10.0::DOUBLE AS demand FROM part"
SILVER_TWINS |= {
    "pricing": _hour_twin("sum_view IS NOT NULL", {"price": "avg_view", "priceUsd": "CASE WHEN hour(t) % 6 <> 5 THEN avg_view / 32 END", "priceEur": "avg_view / 35"}, ["date", "hour"], _by_hour),
    "smf": _hour_twin("sum_purchase IS NOT NULL", {"systemMarginalPrice": "avg_purchase"}, ["date"]),
    "consumption": _hour_twin("true", {"consumption": "every * 0.98"}, ["date", "hour"], _by_hour),
    "generation": _hour_twin("true", _bands(GENERATION_FUELS, "1.0", "total"), ["date"]),
    "imbalance": _hour_twin("true", {"generationTotal": _made, "consumption": _used, "imbalanceQuantity": f"round({_made} - ({_used}), 3)"}, ["date"]),
    "dam_clearing": _hour_twin("true", {"matchedBids": _zero("view", "click"), "matchedOffers": _zero("purchase", "signup")}, ["date"]),
    "order_up": _hour_twin("sum_error IS NOT NULL", _order_columns("error", "up"), ["date", "hour", "time"], _by_hour),
    "order_down": _hour_twin("sum_click IS NOT NULL", _order_columns("click", "down"), ["date", "hour", "time"], _by_hour),
    "system_direction": _hour_twin("sum_view IS NOT NULL OR sum_click IS NOT NULL", {"systemDirection": f"CASE WHEN {_net} < 0 THEN 'Enerji Açığı' WHEN {_net} > 0 THEN 'Enerji Fazlası' ELSE 'Dengede' END"}, ["date", "hour"], _by_hour, ("systemDirection",)),
    "dpp": _hour_twin("sum_view IS NOT NULL", _bands(PLAN_FUELS, "1.0"), ["date", "time"], _by_time),
    "aic": _hour_twin("true", _bands(PLAN_FUELS[:-1], "2.0"), ["date"]),
    "res_forecast": _hour_twin("sum_signup IS NOT NULL OR sum_click IS NOT NULL", {"forecast": "sum_signup", "generation": "sum_click"}, ["date"]),
    "load_estimation": _hour_twin("true", {"lep": "every"}, ["date"]),
    "price_ind_bid": _hour_twin("sum_view IS NOT NULL", {"bidVolume": "sum_view * 0.5"}, ["date"]),
    "unlicensed": _hour_twin("sum_click IS NOT NULL", _bands(UNLICENSED, "0.1"), ["date"]),
    "dam_clearing_by_org": _silver_twin(_by_org, ["date", "hour", "organizationId", "organizationName", "matchedBids", "matchedOffers"], ["date", "hour", "organizationId"], ["date", "hour", "organizationId", "organizationName"], f"{_by_hour} || '||' || \"organizationId\""),
    "kgup_bulk_by_org": _silver_twin(_kgup_rows, ["date", "time", "orgId", "uevcbId", "uevcbName", "toplam", *PLAN_FUELS], ["date", "time", "orgId", "uevcbId"], ["date", "time", "orgId", "uevcbId", "uevcbName"], f"{_by_time} || '||' || \"orgId\" || '||' || \"uevcbId\""),
    "outages": tuple(x.replace("strftime(date,", 'strftime("caseStartDate",') for x in _silver_twin(_outage_rows, ["id", "caseStartDate", "caseEndDate", "orgName", "powerPlantName", "operatorPower", "capacityAtCaseTime", "reason"], ["id"], ["id", "caseStartDate", "caseEndDate", "orgName", "powerPlantName", "reason"], "id::VARCHAR")),
    "supply_demand": _silver_twin(_curve_rows, ["date", "price", "supply", "demand"], ["date", "price"], ["date"], f"{_at} || '||' || price"),
}

for number, name in enumerate(bronze.JOBS, 1):
    if hasattr(Silver, f"_{name}"):
        _add(f"SI{number}_{name}", _silver_job(name), *SILVER_TWINS.get(name, ()))


def _gen_forecast(lake: Lake) -> DataFrame:
    df = lake.silver["res_forecast"].select("date", F.col("forecast").cast("string").alias("forecast"))
    return bronze.normalise(df.withColumn("date", F.date_format("date", "yyyy-MM-dd'T'HH:mm:ssXXX")), bronze.JOBS["gen_forecast"])


def _injection(lake: Lake) -> DataFrame:
    df = lake.silver["kgup_bulk_by_org"].select(F.date_format("date", "yyyy-MM-dd'T'HH:mm:ssXXX").alias("date"), F.col("time").alias("hour"), F.col("toplam").cast("string").alias("total"), F.col("orgId").alias("organizationId"), "uevcbId")
    return bronze.normalise(df, bronze.JOBS["injection"])


_res_rows = "SELECT t AS date, sum_signup AS forecast FROM slv WHERE sum_signup IS NOT NULL OR sum_click IS NOT NULL"
_injected = f"SELECT {_line_at} AS hour, l_quantity AS total, l_suppkey AS \"organizationId\", l_partkey AS \"uevcbId\" {_lines_from}"
_add("SI18_gen_forecast", _gen_forecast, *_silver_twin(_res_rows, ["date", "forecast"], ["date"], ["date"], _at))
_add("SI22_injection", _injection, *_silver_twin(_injected, ["date", "hour", "total", "organizationId", "uevcbId"], ["date", "hour"], ["date", "hour", "organizationId", "uevcbId"], _by_hour))
_add("SI29_uevcb_list", lambda lake: bronze.normalise(lake.silver.table("part").select(F.col("p_partkey").cast("string").alias("id"), (F.col("p_partkey") % 7).cast("string").alias("organizationId")), bronze.JOBS["uevcb_list"], AS_OF), f"SELECT p_partkey AS id, p_partkey % 7 AS \"organizationId\", DATE '{AS_OF}' AS ds, md5(p_partkey::VARCHAR) AS _record_hash, '2024' AS year, '01' AS month, '31' AS day FROM part")
_add("SI30_market", lambda lake: bronze.normalise(lake.silver.table("supplier").select(F.col("s_suppkey").alias("organizationId"), (F.col("s_acctbal") > 0).cast("string").alias("active"), "s_name"), bronze.JOBS["market"], AS_OF), f"SELECT s_suppkey AS org_id, s_acctbal > 0 AS is_active, s_name, DATE '{AS_OF}' AS ds, md5(s_suppkey::VARCHAR) AS _record_hash, '2024' AS year, '01' AS month, '31' AS day FROM supplier")


def _trades(lake: Lake) -> DataFrame:
    return lake["idm_transactions"].select("date", "hour", "id", "price_try", "quantity_mwh")


_trade_sql = "SELECT date, hour, id, price_try, quantity_mwh FROM idm_transactions"


def _drift(lake: Lake) -> DataFrame:
    path, spark = folder(lake.silver.spark), lake.silver.spark
    orders = lake.silver.table("orders").select("o_orderkey", "o_totalprice")
    orders.where("o_orderkey % 2 = 0").write.parquet(f"{path}/a")
    orders.where("o_orderkey % 2 = 1").select("o_orderkey", F.floor("o_totalprice").cast("long").alias("o_totalprice"), F.lit("x").alias("note")).write.parquet(f"{path}/b")
    return bronze.read_drift_safe(spark, [f"{path}/a", f"{path}/b"])


def _envelope(lake: Lake) -> DataFrame:
    rows = lake.silver.table("lineitem").groupBy("l_orderkey").agg(F.collect_list(F.struct("l_linenumber", "l_quantity")).alias("items"))
    return bronze.flatten_envelope(rows.select(F.struct("l_orderkey", "items").alias("body")))


def _round_trip(lake: Lake) -> DataFrame:
    """Write by day, overwrite one day with a correction, read back."""
    path = folder(lake.silver.spark)
    rows = keyed.day_partitions(_trades(lake), "date")
    bronze.write_silver(rows, path)
    bronze.write_silver(rows.where("date = DATE '2024-01-05'").withColumn("price_try", F.col("price_try") + 1000), path)
    return lake.silver.spark.read.parquet(path).select("date", "hour", "id", "price_try", "quantity_mwh")


def _recent(lake: Lake) -> DataFrame:
    path = folder(lake.silver.spark)
    bronze.write_silver(keyed.day_partitions(_trades(lake), "date"), path)
    return bronze.recent_partitions(lake.silver.spark.read.parquet(path), AS_OF).select("date", "hour", "id", "price_try", "quantity_mwh")


def _batch(lake: Lake) -> DataFrame:
    spark, path = lake.silver.spark, folder(lake.silver.spark)
    for source in ("pricing", "smf", "system_direction"):
        raw(lake, source).write.parquet(f"{path}/bronze/{source}")
    raw(lake, "dams").where("false").write.parquet(f"{path}/bronze/dams")
    inputs = {s: f"{path}/bronze/{s}" for s in ("pricing", "smf", "system_direction", "dams", "weather")}
    return bronze.run_jobs(spark, inputs, f"{path}/silver").drop("error")


def _registered(lake: Lake) -> DataFrame:
    spark, path = lake.silver.spark, folder(lake.silver.spark)
    bronze.write_silver(keyed.day_partitions(_trades(lake), "date"), path)
    name = bronze.register(spark, {f"trades_{uuid.uuid4().hex[:8]}": path})[0]
    return spark.table(name).groupBy("year", "month", "day").agg(F.count("*").alias("n"))


def _lookback(lake: Lake) -> DataFrame:
    """Late prices of yesterday's last two hours replace what was written."""
    path = folder(lake.silver.spark)
    first = lake["smf"]
    incremental.replace_partitions(first, path)
    late = first.where("date = DATE '2024-01-10' AND hour >= 22").withColumn("smf_try", F.col("smf_try") + 500)
    incremental.upsert(late, path, ["date", "hour"])
    return lake.silver.spark.read.parquet(path).select("date", "hour", "smf_try")


def _listed(lake: Lake) -> DataFrame:
    """Rows of the files that are listed, found by the file each row lies in."""
    where = f"{lake.silver.sf_dir}/events.parquet"
    there = bronze.list_files(lake.silver.spark, where).where("length > 0").select(F.regexp_replace("path", "^[a-z]+:/*", "/").alias("path"))
    rows = lake.silver.table("events").select(F.regexp_replace("_metadata.file_path", "^[a-z]+:/*", "/").alias("path"), "value").groupBy("path").agg(F.count("*").alias("n"), F.sum("value").alias("v"))
    return rows.join(there, "path").agg(F.sum("n").alias("n_rows"), F.sum("v").alias("total"))


def _incremental_stage(lake: Lake) -> DataFrame:
    """A staged table with the days up to the 19th, and a run for what came since: its last two days are staged anew."""
    path, spark = folder(lake.silver.spark), lake.silver.spark
    incremental.replace_partitions(lake["pricing"].where("date < DATE '2024-01-20'").withColumn("ptf_usd", F.when(F.col("date") < "2024-01-18", F.col("ptf_usd"))), path)
    since = incremental.read(spark, path).agg(F.date_sub(F.max("date"), 1)).first()[0]
    incremental.upsert(staging.stage(staging.MODELS["pricing"], lake.silver["pricing"], since), path, ["date", "hour"])
    return spark.read.parquet(path).select("date", "hour", "ptf_try", "ptf_usd", "ptf_eur")


_smf_late = "SELECT date, hour, smf_try + CASE WHEN date = DATE '2024-01-10' AND hour >= 22 THEN 500 ELSE 0 END AS smf_try FROM smf"
_add("IO1_read_bronze_missing", lambda lake: bronze.read_bronze(lake.silver.spark, f"{lake.silver.sf_dir}/events.parquet", lake.silver.table("events").schema).groupBy("event_type").agg(F.count("*").alias("n")).unionByName(bronze.read_bronze(lake.silver.spark, f"{lake.silver.sf_dir}/no-such.parquet", lake.silver.table("events").schema).groupBy("event_type").agg(F.count("*").alias("n"))), "SELECT event_type, count(*) AS n FROM events GROUP BY 1")
_add("IO2_read_drift_safe", _drift, "SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN o_totalprice ELSE floor(o_totalprice) END AS o_totalprice, CASE WHEN o_orderkey % 2 = 1 THEN 'x' END AS note FROM orders", "o_orderkey", "note")
_add("IO4_list_files", _listed, "SELECT count(*) AS n_rows, sum(value) AS total FROM events", "n_rows")
_add("IO5_flatten_envelope", _envelope, "SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem", "l_orderkey", "l_linenumber")
_add("IO7_touched_partitions", _round_trip, f"SELECT date, hour, id, price_try + CASE WHEN date = DATE '2024-01-05' THEN 1000 ELSE 0 END AS price_try, quantity_mwh FROM ({_trade_sql})", "date", "hour", "id")
_runs = {"pricing": "sum_view IS NOT NULL", "smf": "sum_purchase IS NOT NULL", "system_direction": "sum_view IS NOT NULL OR sum_click IS NOT NULL"}
_add("IO9_run_jobs", _batch, " UNION ALL ".join(f"SELECT '{n}' AS source, 'OK' AS status, count(DISTINCT t) AS n_rows FROM slv WHERE {c}" for n, c in _runs.items()) + " UNION ALL SELECT 'dams', 'EMPTY', 0 UNION ALL SELECT 'weather', 'FAILED', 0")
_add("IO10_register_tables", _registered, "SELECT year(date)::INT AS year, month(date)::INT AS month, day(date)::INT AS day, count(*) AS n FROM idm_transactions GROUP BY 1, 2, 3")
_add("IO11_lookback_rewrite", _lookback, _smf_late, "date", "hour")
_add("IO12_integers_to_double", lambda lake: bronze.integers_to_double(lake.silver.table("lineitem").select("l_orderkey", "l_linenumber", "l_quantity")), "SELECT l_orderkey::DOUBLE AS l_orderkey, l_linenumber::DOUBLE AS l_linenumber, l_quantity FROM lineitem")
_columns = {"events": {"event_id": "bigint", "ts": "timestamp_ntz", "user_id": "bigint", "event_type": "string", "value": "double", "props": "string"}, "orders": {"o_orderkey": "bigint", "o_custkey": "bigint", "o_orderstatus": "string", "o_totalprice": "double", "o_orderdate": "timestamp_ntz", "o_orderpriority": "string"}}
_add("IO13_profile", lambda lake: bronze.profile({"events": lake.silver.table("events"), "orders": lake.silver.table("orders")}), " UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS n_rows, '{c}' AS column_name, '{kind}' AS data_type, count(*) - count({c}) AS n_nulls FROM {t}" for t, cs in _columns.items() for c, kind in cs.items()))
_add("TG6_incremental_stage", _incremental_stage, "SELECT date, hour, ptf_try, ptf_usd, ptf_eur FROM pricing", "date", "hour")
_add("IO14_landed", lambda lake: bronze.landed(lake.silver.events().select("event_id", "ts", "value")), "SELECT event_id::DOUBLE AS event_id, strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS ts, value FROM ev", "ts")
_fuels = {new: new.removesuffix("_generation_mwh").removesuffix("_mwh") for new in GENERATION if new != "total_generation_mwh"}
_add("IO15_melted_fuels", lambda lake: bronze.melted(lake["generation"], ["date", "hour"], _fuels), " UNION ALL ".join(f"SELECT date, hour, '{f}' AS fuel, {c} AS mwh FROM generation" for c, f in _fuels.items()), "date", "hour", "fuel")
_add("IO16_recent_partitions", _recent, f"{_trade_sql} WHERE date >= DATE '{AS_OF}' - 7", "date", "hour", "id")

_add("NO1_parse_instant", lambda lake: lake.silver.events().select("event_id", keyed.parse_instant(F.concat(F.date_format(F.col("ts") + F.expr("interval 3 hours"), "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+03:00"))).alias("ts")), "SELECT event_id, date_trunc('second', ts) AS ts FROM events")
_add("NO3_nanos", lambda lake: lake.silver.events().select("event_id", keyed.nanos_instant(F.unix_micros("ts") * 1000).alias("ts")), "SELECT event_id, ts FROM events")
_add("NO4_cast_all_but", lambda lake: keyed.cast_all_but(lake.silver.table("lineitem").select("l_orderkey", F.col("l_partkey").cast("string").alias("l_partkey"), "l_returnflag"), ["l_orderkey"]), "SELECT l_orderkey, l_partkey::DOUBLE AS l_partkey, NULL::DOUBLE AS l_returnflag FROM lineitem", "l_orderkey")
_add("NO7_keyed_dedup", lambda lake: keyed.keyed_dedup(lake.silver.table("lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"), ["l_orderkey", "l_linenumber"]), "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_partkey DESC, l_suppkey DESC) = 1")
_add("NO8_record_hash", lambda lake: lake.silver.table("orders").select("o_orderkey", keyed.record_hash(["o_orderkey", "o_orderstatus", "o_orderpriority"]).alias("h")), "SELECT o_orderkey, md5(o_orderkey || '||' || o_orderstatus || '||' || o_orderpriority) AS h FROM orders")
_add("NO10_fetch_window", lambda lake: normalize.fetch_window(lake.silver.events().select("event_id", F.col("ts").alias("date")), "2024-01-15", 2, 1), "SELECT event_id, ts AS date FROM events WHERE ts::DATE BETWEEN DATE '2024-01-13' AND DATE '2024-01-16'")
_add("NO13_computed_imbalance", lambda lake: normalize.computed_imbalance(lake.silver.hours().groupBy("date").agg(F.sum("sum_click").alias("total")), lake.silver.hours().where("sum_view IS NOT NULL").groupBy("date").agg(F.sum("sum_view").alias("consumption"))), "SELECT date, g AS \"generationTotal\", c AS consumption, round(g - c, 3) AS \"imbalanceQuantity\", CASE WHEN round(g - c, 3) > 0 THEN 'ENERGY_SURPLUS' WHEN round(g - c, 3) < 0 THEN 'ENERGY_DEFICIT' ELSE 'BALANCED' END AS \"systemDirection\" FROM (SELECT t AS date, coalesce(sum(sum_click), 0) AS g, coalesce(sum(sum_view), 0) AS c FROM slv GROUP BY 1)", "date", "\"systemDirection\"")
_add("NO14_with_roster", lambda lake: normalize.with_roster(lake.silver.table("lineitem").select(F.col("l_suppkey").alias("organization_id"), "l_orderkey", "l_linenumber"), lake["participants"].select("organization_id", "organization_name"), "organization_id"), "SELECT l_suppkey AS organization_id, l_orderkey, l_linenumber, s_name AS organization_name FROM lineitem LEFT JOIN supplier ON l_suppkey = s_suppkey")
_add("NO15_unique_units", lambda lake: normalize.unique_units(lake.silver.table("lineitem"), "l_partkey"), "SELECT DISTINCT l_partkey FROM lineitem")
_cities = dict(zip(normalize.CITY_WEIGHTS, ("city0", "city1", "city2", "city3"), strict=True))
_named = "CASE city_name " + " ".join(f"WHEN '{v}' THEN '{k}'" for k, v in _cities.items()) + " END"
_weights = lambda i: "CASE c " + " ".join(f"WHEN '{k}' THEN {w[i]}" for k, w in normalize.CITY_WEIGHTS.items()) + " END"
_sums = ", ".join(f"sum({c} * {_weights(i)}) / nullif(sum({_weights(i)}) FILTER ({c} IS NOT NULL), 0) AS {v}" for v, c, i in (("temperature_2m", "temperature_celsius", 0), ("wind_speed_10m", "wind_speed_kmh", 1), ("shortwave_radiation", "shortwave_radiation", 2), ("relative_humidity_2m", "relative_humidity", 0)))
_own = ", ".join(f"max(temperature_celsius) FILTER (c = '{k}') AS temperature_2m_{k}" for k in _cities)


def _weather(lake: Lake) -> DataFrame:
    names = F.create_map(*[F.lit(x) for k, v in _cities.items() for x in (v, k)])
    return normalize.national_weather(lake.silver["weather"].withColumn("city", names[F.col("city")]))


_add("NO16_national_weather", _weather, f"SELECT (date::TIMESTAMP + hour * INTERVAL 1 HOUR - INTERVAL 3 HOUR) AS date, {_sums}, {_own} FROM (SELECT *, {_named} AS c FROM weather) GROUP BY 1", "date")
_add("NO17_filled_rates", lambda lake: normalize.filled_rates(lake["fx_rates"].where("day(date) % 3 <> 0"), lake["fx_rates"].select("date").unionByName(lake["fx_rates"].select(F.date_add("date", 1).alias("date"))).distinct()), "WITH q AS (SELECT date, usdtry FROM fx_rates WHERE day(date) % 3 <> 0), d AS (SELECT DISTINCT date FROM (SELECT date FROM fx_rates UNION ALL SELECT date + 1 FROM fx_rates)) SELECT d.date, max_by(q.usdtry, q.date) AS usdtry, max(q.date) < d.date AS is_ffilled FROM d LEFT JOIN q ON q.date BETWEEN d.date - 5 AND d.date GROUP BY d.date", "date", "is_ffilled")
_add("NO18_weekdays", lambda lake: lake["fx_rates"].select("date").join(normalize.weekdays("2019-01-01", "2032-12-31", lake.silver.spark), "date"), "SELECT date FROM fx_rates")


def _with_table(lake: Lake, steps: Callable[[str], None]) -> DataFrame:
    path = folder(lake.silver.spark)
    incremental.replace_partitions(lake["smf"].where("date < DATE '2024-01-20'"), path)
    steps(path)
    return lake.silver.spark.read.parquet(path).select("date", "hour", "smf_try")


def _news(lake: Lake) -> DataFrame:
    return lake["smf"].where("date >= DATE '2024-01-18' AND hour < 12").withColumn("smf_try", F.col("smf_try") + 7)


_key, _n = ["date", "hour"], "date >= DATE '2024-01-18' AND hour < 12"
_add("IN1_upsert", lambda lake: _with_table(lake, lambda p: [incremental.upsert(_news(lake), p, _key) for _ in range(2)]), f"SELECT date, hour, smf_try + CASE WHEN {_n} THEN 7 ELSE 0 END AS smf_try FROM smf WHERE date < DATE '2024-01-20' OR ({_n})", *_key)
_add("IN2_replace_partitions", lambda lake: _with_table(lake, lambda p: incremental.replace_partitions(_news(lake), p)), f"SELECT date, hour, smf_try + 7 AS smf_try FROM smf WHERE {_n} UNION ALL SELECT date, hour, smf_try FROM smf WHERE date < DATE '2024-01-18' OR (date < DATE '2024-01-20' AND date NOT IN (SELECT date FROM smf WHERE {_n}))", *_key)
_add("IN3_rebuild", lambda lake: _with_table(lake, lambda p: incremental.rebuild(_news(lake), p, "date")), f"SELECT date, hour, smf_try + 7 AS smf_try FROM smf WHERE {_n}", *_key)
_add("IN4_since_watermark", lambda lake: incremental.since_watermark(lake["smf"].where("date < DATE '2024-01-20'"), lake["smf"], lookback_days=1), "SELECT * FROM smf WHERE date >= (SELECT max(date) - 1 FROM smf WHERE date < DATE '2024-01-20')", *_key)
_add("IN5_insert_once", lambda lake: _with_table(lake, lambda p: [incremental.insert_once(_news(lake), p, _key) for _ in range(2)]), f"SELECT date, hour, smf_try + CASE WHEN date < DATE '2024-01-20' THEN 0 ELSE 7 END AS smf_try FROM smf WHERE date < DATE '2024-01-20' OR ({_n})", *_key)
_add("IN7_delete_matching", lambda lake: _with_table(lake, lambda p: incremental.delete_matching(p, lake["smf"].where("date = DATE '2024-01-04' OR hour = 3"), _key)), "SELECT date, hour, smf_try FROM smf WHERE date < DATE '2024-01-20' AND NOT (date = DATE '2024-01-04' OR hour = 3)", *_key)
_add("IN9_window_rewrite", lambda lake: marts.lag_features(incremental.window_input(lake["smf"].join(lake["system_direction"], _key, "left"), "2024-01-25", 24)).where("date >= DATE '2024-01-25'").select("date", "hour", "smf_try", "smf_try_lag_5h"), "SELECT * FROM (SELECT date, hour, smf_try, lag(smf_try, 5) OVER (ORDER BY date, hour) AS smf_try_lag_5h FROM smf) WHERE date >= DATE '2024-01-25'", *_key)
