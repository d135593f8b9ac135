"""Market operators: hand-made cases, properties, and the DuckDB twins on the smallest tables."""

import datetime as dt
import math

import duckdb
import pytest
from pyspark.sql import functions as F

from gridlake.functions import expressions as ex
from gridlake.operators import incremental, keyed, normalize, quality
from gridlake.plans import marts, registry, reports, signal, staging
from gridlake.sources import bronze
from gridlake.sources.bindings import Silver

TABLES = "region nation customer supplier part orders lineitem events"


class Tables(dict):
    """A lake made of given staged tables."""


def one(spark, expression, **values):
    row = spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()])
    return row.select(expression.alias("x")).collect()[0]["x"]


def at(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


D = dt.date


def test_local_keys(spark):
    t = at(spark, [(dt.datetime(2025, 1, 1, 21),)], "ts timestamp")
    assert tuple(t.select(ex.local_date("ts"), ex.local_hour("ts")).collect()[0]) == (D(2025, 1, 2), 0)
    back = at(spark, [(D(2026, 6, 5), 22)], "date date, hour int").select(ex.instant_of().alias("t")).collect()[0]["t"]
    assert back == dt.datetime(2026, 6, 5, 19)


def test_settlement(spark):
    lake = Tables(
        imbalance=at(spark, [(D(2025, 1, 1), h, n) for h, n in enumerate((-10.0, 10.0, 0.0, -1.0, 1.0))], "date date, hour int, net_imbalance_mwh double"),
        pricing=at(spark, [(D(2025, 1, 1), h, p) for h, p in enumerate((100.0, 100.0, 100.0, 100.0, None))], "date date, hour int, ptf_try double"),
        smf=at(spark, [(D(2025, 1, 1), h, s) for h, s in enumerate((120.0, 120.0, 120.0, None, 120.0))], "date date, hour int, smf_try double"),
    )
    rows = {r["hour"]: r for r in marts.imbalance_cost(lake).collect()}
    assert [(rows[h]["settlement_price_try"], rows[h]["total_imbalance_cost_try"]) for h in range(5)] == [(123.6, -1236.0), (97.0, 970.0), (100.0, 0.0), (103.0, -103.0), (None, None)]


def test_weighted_price(spark):
    rows = at(spark, [(1, 100.0, 1.0), (1, 200.0, 3.0), (2, 5.0, 0.0)], "k int, price_try double, quantity_mwh double")
    assert {r["k"]: r["v"] for r in rows.groupBy("k").agg(ex.weighted_price().alias("v")).collect()} == {1: 175.0, 2: None}


def test_normal(spark):
    for z in (-3.0, -0.5, 0.0, 1.0, 2.5):
        assert abs(one(spark, ex.normal_cdf(F.col("z")), z=z) - (1 + math.erf(z / math.sqrt(2))) / 2) < 2e-7
    high = one(spark, ex.expected_max(F.col("m"), F.col("s"), F.col("a")), m=100.0, s=10.0, a=100.0)
    low = one(spark, ex.expected_min(F.col("m"), F.col("s"), F.col("a")), m=100.0, s=10.0, a=100.0)
    assert (round(high, 3), round(low, 3)) == (103.989, 96.011)
    assert one(spark, ex.expected_max(F.col("m"), F.col("s"), F.col("a")), m=90.0, s=0.0, a=100.0) == 100.0


def test_recency_and_blocks(spark):
    assert one(spark, ex.recency_weight("d"), d=90) == 0.5
    assert [one(spark, ex.price_block("h"), h=h) for h in (5, 6, 16, 17, 21, 22)] == ["Gece", "Gündüz", "Gündüz", "Puant", "Puant", "Gece"]


def test_spans(spark):
    rows = [("a", "2025-01-01 00:00:00", "2025-01-03 00:00:00", 5.0), ("b", "2025-01-03 00:00:00", "2025-01-01 00:00:00", 9.0), ("c", "2025-01-02 00:00:00", "2025-02-01 00:00:00", 2.0), ("d", None, "2025-01-01 00:00:00", 1.0)]
    raw = at(spark, rows, "id string, s string, e string, outage_capacity_mwh double")
    table = raw.select("id", F.to_date("s").alias("date"), F.col("s").cast("timestamp").alias("start_time"), F.col("e").cast("timestamp").alias("end_time"), F.lit("c").alias("company_name"), F.lit("p").alias("plant_name"), F.lit(1.0).alias("installed_capacity_mwh"), "outage_capacity_mwh", F.lit("r").alias("outage_reason"))
    assert staging.outages_daily(table, "2025-01-04").groupBy("id").count().orderBy("id").collect() == [("a", 3), ("c", 3)]
    days = {r["date"].day: r["total_outage_mwh"] for r in marts.outage_days(Tables(outages=table), "2025-01-04").collect()}
    assert days == {1: 5.0, 2: 7.0, 3: 7.0, 4: 2.0}
    assert marts.outage_days(Tables(outages=table.where("false")), "2025-01-04").count() == 0


def test_eight_hour_windows(spark):
    rising = at(spark, [(D(2025, 1, 1), h, h + 1.0) for h in range(24)] + [(D(2025, 1, 2), h, 1.0) for h in range(7)], "date date, hour int, ptf_try double")
    first, second = marts.shift_optimizer(Tables(pricing=rising)).orderBy("date").collect()
    assert (first["cheapest_8h_start_hour"], first["cheapest_8h_avg_ptf"], first["priciest_8h_start_hour"], first["priciest_8h_avg_ptf"], first["max_shift_saving_per_mwh"]) == (0, 4.5, 16, 20.5, 16.0)
    assert second["cheapest_8h_start_hour"] is None


def test_dedup(spark):
    rows = at(spark, [(1, "a"), (1, "b"), (2, "c"), (None, "d")], "id long, v string")
    kept = keyed.keyed_dedup(rows, ["missing"])
    assert kept.count() == 3 and keyed.keyed_dedup(kept, ["id"]).count() == 3
    assert keyed.keyed_dedup(at(spark, [(1,), (1,)], "x int"), None).count() == 1
    assert keyed.with_record_hash(rows, None).columns == rows.columns


def test_drift_and_envelope(spark, tmp_path):
    at(spark, [(1, 5)], "k long, v long").write.parquet(f"{tmp_path}/a")
    at(spark, [(2, 2.5, "n")], "k long, v double, note string").write.parquet(f"{tmp_path}/b")
    got = bronze.read_drift_safe(spark, [f"{tmp_path}/a", f"{tmp_path}/b"])
    assert dict(got.dtypes)["v"] == "double" and {tuple(r) for r in got.collect()} == {(1, 5.0, None), (2, 2.5, "n")}
    nested = at(spark, [({"items": [(1, "x"), (2, "y")], "page": 1},)], "body struct<items:array<struct<a:int,b:string>>,page:int>")
    assert bronze.flatten_envelope(nested).orderBy("a").collect() == [(1, 1, "x"), (1, 2, "y")]
    assert bronze.read_bronze(spark, f"{tmp_path}/none", got.schema).count() == 0


def test_jobs_isolate_failures(spark, tmp_path):
    at(spark, [("2025-01-01T00:00:00+03:00", "7.5")], "date string, systemMarginalPrice string").write.parquet(f"{tmp_path}/smf")
    out = {r["source"]: r["status"] for r in bronze.run_jobs(spark, {"smf": f"{tmp_path}/smf", "dams": f"{tmp_path}/none"}, f"{tmp_path}/out").collect()}
    assert out == {"smf": "OK", "dams": "FAILED"}
    row = spark.read.parquet(f"{tmp_path}/out/smf").collect()[0]
    assert (row["systemMarginalPrice"], row["date"]) == (7.5, dt.datetime(2024, 12, 31, 21))


def test_upserts(spark, tmp_path):
    path = f"{tmp_path}/t"
    old = at(spark, [(D(2025, 1, 1), 0, 1.0), (D(2025, 1, 1), 1, 2.0), (D(2025, 1, 2), 0, 3.0)], "date date, hour int, v double")
    new = at(spark, [(D(2025, 1, 1), 1, 9.0), (D(2025, 1, 3), 0, 4.0)], "date date, hour int, v double")
    rows = lambda: sorted((r["date"].day, r["hour"], r["v"]) for r in spark.read.parquet(path).collect())
    incremental.upsert(old, path, ["date", "hour"])
    for _ in range(2):
        incremental.upsert(new, path, ["date", "hour"])
        assert rows() == [(1, 0, 1.0), (1, 1, 9.0), (2, 0, 3.0), (3, 0, 4.0)]
    incremental.insert_once(at(spark, [(D(2025, 1, 1), 1, 0.0), (D(2025, 1, 1), 2, 5.0)], "date date, hour int, v double"), path, ["date", "hour"])
    assert rows()[:3] == [(1, 0, 1.0), (1, 1, 9.0), (1, 2, 5.0)]
    incremental.delete_matching(path, at(spark, [(D(2025, 1, 2), 0), (D(2025, 1, 1), 0)], "date date, hour int"), ["date", "hour"])
    assert rows() == [(1, 1, 9.0), (1, 2, 5.0), (3, 0, 4.0)]


def test_tables_are_made_and_failures_are_told(spark, tmp_path):
    path = f"file://{tmp_path}/made"
    rows = at(spark, [(D(2025, 1, 1), 0, 1.0, 5), (D(2025, 1, 1), 0, 2.0, 3)], "date date, hour int, v double, told int")
    assert incremental.create_if_missing(spark, path, rows.schema).collect() == [] and not incremental.exists(spark, path)
    incremental.insert_once(rows, path, ["date", "hour"], order="told")
    assert [tuple(r) for r in incremental.create_if_missing(spark, path, rows.schema).collect()] == [(D(2025, 1, 1), 0, 2.0, 3)]
    assert spark.read.parquet(path).inputFiles()[0].find("date=2025-01-01") > 0
    (tmp_path / "bad").mkdir()
    (tmp_path / "bad" / "part-0.parquet").write_text("not a table")
    with pytest.raises(Exception, match=r"(?i)parquet|footer"):
        incremental.upsert(rows, f"file://{tmp_path}/bad", ["date", "hour"])
    assert (tmp_path / "bad" / "part-0.parquet").read_text() == "not a table"


def test_area_under_the_curve(spark):
    rows = [(s, y) for s, y in ((0.1, 0), (0.2, 1), (0.2, 0), (0.7, 1), (0.9, 1), (0.4, 0), (0.35, 1), (0.9, 0))]
    pairs = [(p, q) for p, y in rows if y for q, z in rows if not z]
    wanted = sum((p > q) + 0.5 * (p == q) for p, q in pairs) / len(pairs)
    from gridlake.plans.forecast import rank_auc

    table = at(spark, rows, "s double, y int")
    assert abs(rank_auc(table, "s", F.col("y") == 1).collect()[0][0] - wanted) < 1e-12


def test_feature_plans_join_aligned_files(spark, sf):
    """Every scan and exchange of the plan counts, whatever it reads."""
    for name, scans, exchanges in (("MA17_ml_features", 8, 4), ("MA31_smf_lag_features", 8, 4), ("MA30_smf_forward_features", 10, 6), ("MA4_cross_market_spread", 4, 6)):
        plan = registry.QUERIES[name](spark, sf)._jdf.queryExecution().executedPlan().toString()
        lines = plan.split("== Initial Plan ==")[0].splitlines()
        assert sum("FileScan" in x for x in lines) <= scans, name
        assert sum("Exchange" in x and "BroadcastExchange" not in x and "ReusedExchange" not in x for x in lines) <= exchanges, name


def test_filled_rates(spark):
    quotes = at(spark, [(D(2025, 1, 3), 30.0)], "date date, usdtry double")
    days = at(spark, [(D(2025, 1, d),) for d in (2, 3, 5, 8, 9)], "date date")
    assert [tuple(r)[1:] for r in normalize.filled_rates(quotes, days).orderBy("date").collect()] == [(None, None), (30.0, False), (30.0, True), (30.0, True), (None, None)]


def test_gaps_and_checks(spark):
    hours = at(spark, [(D(2025, 1, d), h) for d in (1, 2, 3, 4) for h in range(24) if (d, h) not in {(1, 5), (4, 9)}], "date date, hour int")
    assert quality.hourly_gaps(hours, "2025-01-05").collect() == [(D(2025, 1, 1), 5)]
    results = quality.check_results({("gaps", "error"): quality.hourly_gaps(hours, "2025-01-05"), ("ok", "error"): hours.where("false")})
    with pytest.raises(ValueError, match="gaps"):
        quality.stop_on_errors(results)
    assert quality.hourly_gaps(hours.where("false"), "2025-01-05").count() == 0
    # A feed that stopped on 4 January lacks every hour of the days up to two before the end of the month.
    assert quality.hourly_gaps(hours, "2025-01-31").count() == 24 * 24 + 2
    assert quality.missing_days(hours, "2025-01-31").collect()[0][0] == 27
    assert quality.missing_days(hours.where("false"), "2025-01-31").collect()[0][0] == 0


def test_lags_never_see_their_own_row(spark):
    rows = at(spark, [(D(2025, 1, 1), h, float(h), "x") for h in range(24)], "date date, hour int, smf_try double, system_direction string")
    changed = rows.withColumn("smf_try", F.when(F.col("hour") == 23, 1e9).otherwise(F.col("smf_try")))
    lagged = lambda df: [tuple(r)[4:] for r in marts.lag_features(df).orderBy("hour").collect()]
    assert lagged(rows) == lagged(changed)


def test_perfect_foresight_is_never_beaten(spark, sf):
    lake = registry.lake_of(spark, sf)
    tested = signal.backtest(lake, marts.naive_predictions(lake))
    assert tested.where("short_perfect > short_model + 1e-9 OR long_perfect < long_model - 1e-9").count() == 0
    assert set(reports.confusion(lake, marts.naive_predictions(lake)).columns) == {"system_direction", *reports.CLASSES}


def test_direction_labels(spark):
    rows = at(spark, [("Enerji Açığı",), ("Dengede",), ("else",), (None,)], "s string")
    assert [r[0] for r in rows.select(staging.normalised_direction(F.col("s"))).collect()] == ["ENERGY_DEFICIT", "IN_BALANCE", "else", None]


SAMPLE = ["MA4_cross_market_spread", "MA15_imbalance_cost", "MA17_ml_features", "MA28_shift_optimizer", "MA30_smf_forward_features", "MA34_supply_shock_index", "ST1_pricing", "ST12_kgup_bulk_by_org", "ST25_outages_daily", "BI5_week_grid", "BI20_confusion", "DQ11_coverage", "DQ6_hourly_gaps", "DQ13_missing_days", "DQ13_missing_days_of_a_dead_feed", "SI2_interim_mcp", "SI10_idm_transactions", "SI15_sbfgp", "SI25_dams", "SI26_weather", "SI27_fx_rates", "SI28_participants", "IN1_upsert", "IN7_delete_matching", "IO7_touched_partitions", "NO16_national_weather", "NO17_filled_rates", "TS2_residual_sigma"]


@pytest.mark.parametrize("name", SAMPLE)
def test_twins(spark, sf, name):
    con = duckdb.connect()
    for table in TABLES.split():
        con.sql(f"CREATE VIEW {table} AS SELECT * FROM '{sf}/{table}.parquet'")
    plain = lambda v: f"{v:.6g}" if isinstance(v, float) else str(v)
    found, twin = registry.QUERIES[name](spark, sf), con.sql(registry.ORACLE_SQL[name])
    columns = sorted(found.columns)
    assert columns == sorted(twin.columns)
    wanted = twin.select(*[f'"{c}"' for c in columns]).fetchall()
    assert sorted([plain(r[c]) for c in columns] for r in found.collect()) == sorted([plain(v) for v in row] for row in wanted)


def test_every_twin_has_a_query():
    assert set(registry.ORACLE_SQL) <= set(registry.QUERIES)
    assert Silver and len(registry.QUERIES) > 150
