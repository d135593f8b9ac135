"""Registered queries on reports, signals and data quality, with their DuckDB twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.expressions import rounded
from ..operators import quality
from ..sources.bindings import Silver
from ..sources.shared import folder
from . import marts, reports, signal
from .oracles import ANALYSIS, AS_OF, EXTREMES, MIX, RESIDUAL, SHIFTS, SHOCK, SPREAD, TRADE_WEATHER, twin
from .staging import Lake

Plan = Callable[[Lake], DataFrame]
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}
NOW = "2024-01-29 09:00:00"


def _add(name: str, plan: Plan, body: str | None = None, *exact: str) -> None:
    QUERIES[name] = lambda spark, sf_dir: rounded(plan(Lake(Silver(spark, sf_dir))))
    if body:
        ORACLE_SQL[name] = twin(body, *exact) if exact else twin(body, rounded=False)


def _predicted(plan: Callable[[Lake, DataFrame], DataFrame]) -> Plan:
    return lambda lake: plan(lake, marts.naive_predictions(lake))


_month = "strftime(date, '%Y-%m') AS year_month"
_gop = "SELECT date, hour, matched_bids_mwh AS b, matched_offers_mwh AS s, ptf_try FROM dam_clearing LEFT JOIN pricing USING (date, hour)"
_told = "(SELECT date + 1 AS date, hour, smf_try + (hour % 5 - 2) AS p, CASE WHEN hour % 5 - 2 > 0 THEN 'ENERGY_DEFICIT' WHEN hour % 5 - 2 < 0 THEN 'ENERGY_SURPLUS' ELSE 'IN_BALANCE' END AS d FROM smf)"
_plan = "(SELECT date, hour, total_planned_mwh AS a, total_kgup_mwh AS b FROM sbfgp FULL JOIN dpp USING (date, hour))"
_mix = "(SELECT date, hour, total_generation_mwh AS t, (coalesce(wind_generation_mwh, 0) + coalesce(solar_generation_mwh, 0) + coalesce(dam_generation_mwh, 0) + coalesce(river_generation_mwh, 0) + coalesce(geothermal_generation_mwh, 0) + coalesce(biomass_generation_mwh, 0)) / nullif(total_generation_mwh, 0) AS g FROM generation)"
_err = "(SELECT date, hour, forecasted_res_mwh - (coalesce(wind_generation_mwh, 0) + coalesce(solar_generation_mwh, 0)) AS e, coalesce(wind_generation_mwh, 0) + coalesce(solar_generation_mwh, 0) AS a FROM res_forecast FULL JOIN generation USING (date, hour))"
_stress = "(SELECT *, (active_volume - min(active_volume) OVER w) / nullif(max(active_volume) OVER w - min(active_volume) OVER w, 0) AS i, active_volume - lag(active_volume, 7) OVER (PARTITION BY dam_id ORDER BY date) AS c, lag(active_volume, 7) OVER (PARTITION BY dam_id ORDER BY date) AS l FROM dams WINDOW w AS (PARTITION BY dam_id ORDER BY date ROWS BETWEEN 89 PRECEDING AND CURRENT ROW))"
_season_cols = ", ".join(f"avg(ptf_try) FILTER (season = '{s}') AS \"{s}\"" for s in ("Kış", "İlkbahar", "Yaz", "Sonbahar"))
_hour_cols = ", ".join(f"avg(ptf_try) FILTER (hour = {h}) AS h{h}" for h in range(24))

_add("BI1_month_on_month", reports.month_on_month, f"WITH m AS (SELECT {_month}, avg(ptf_try) AS mean_ptf_try, count(*) AS n FROM pricing GROUP BY 1) SELECT *, lag(mean_ptf_try) OVER (ORDER BY year_month) AS previous, (mean_ptf_try - previous) / nullif(previous, 0) * 100 AS change_pct FROM m", "year_month", "n")
_add("BI2_season_by_year", reports.season_by_year, f"SELECT year(date)::INT AS year, {_season_cols} FROM ({ANALYSIS}) GROUP BY 1", "year")
_add("BI3_year_on_year", reports.year_on_year, "WITH m AS (SELECT year(date)::INT AS year, month(date)::INT AS month, sum(active_volume) AS volume FROM dams GROUP BY 1, 2) SELECT m.*, b.volume AS volume_before, (m.volume - b.volume) / nullif(b.volume, 0) * 100 AS change_pct FROM m LEFT JOIN m b ON m.year = b.year + 1 AND m.month = b.month", "year", "month")
_add("BI4_season_spread", reports.season_spread, f"SELECT season, avg(price_spread) AS mean_price_spread, count(*) AS n FROM ({ANALYSIS}) GROUP BY 1", "season", "n")
_add("BI5_week_grid", reports.week_grid, f"SELECT (dayofweek(date) + 1)::INT AS day_of_week, {_hour_cols} FROM pricing GROUP BY 1", "day_of_week")
_add("BI6_price_histogram", lambda lake: reports.histogram(marts.price_analysis(lake), "ptf_try", 10.0, ["price_block"]), f"SELECT price_block, floor(ptf_try / 10) * 10 AS bin, count(*) AS n FROM ({ANALYSIS}) WHERE ptf_try IS NOT NULL GROUP BY 1, 2", "price_block", "n")
_add("BI7_settlement_means", reports.settlement_means, f"SELECT date, avg(deficit_settlement_price) AS mean_deficit_settlement_price, avg(surplus_settlement_price) AS mean_surplus_settlement_price, count(*) AS n FROM ({ANALYSIS}) GROUP BY 1", "date", "n")
_add("BI7_block_by_hour", reports.block_by_hour, f"SELECT price_block, hour, avg(ptf_try) AS mean_ptf_try, count(*) AS n FROM ({ANALYSIS}) GROUP BY 1, 2", "price_block", "hour", "n")
_add("BI8_low_price_hours", reports.low_price_hours, "SELECT hour, count(*) FILTER (ptf_try <= 20) AS low_hours, count(*) FILTER (ptf_try = 0) AS zero_hours, count(*) AS n FROM pricing GROUP BY 1")
_add("BI9_seeded_sample", lambda lake: reports.seeded_sample(marts.prices(lake), ["date", "hour"]), "SELECT date, hour, ptf_try FROM pricing ORDER BY md5(date::VARCHAR || '|' || hour || '|7'), date, hour LIMIT 500", "date", "hour")
_add("BI10_renewable_price_correlation", reports.renewable_price_correlation, f"SELECT corr(g, ptf_try) AS correlation, count(*) AS n FROM {_mix} JOIN pricing USING (date, hour)", "n")
_add("BI10_monthly_mix", reports.monthly_mix, f"SELECT {_month}, avg(total_generation) AS mean_total_generation, avg(renewable_ratio) AS mean_renewable_ratio, avg(fossil_ratio) AS mean_fossil_ratio, count(*) AS n FROM ({MIX}) GROUP BY 1", "year_month", "n")
_add("BI11_market_value", reports.market_value, f"SELECT date, sum(b * ptf_try) AS market_value_try, sum(b) AS total_buy_mwh, sum(s) AS total_sell_mwh FROM ({_gop}) GROUP BY 1", "date")
_add("BI11_buy_sell_profile", reports.buy_sell_profile, f"SELECT hour, avg(b) AS mean_total_buy_mwh, avg(s) AS mean_total_sell_mwh, count(*) AS n FROM ({_gop}) GROUP BY 1", "hour", "n")
_add("BI12_merit_split", reports.merit_split, "SELECT date, CASE WHEN bid_offer_price_try <= ptf_try THEN 'In Merit (Eşleşti)' ELSE 'Out of Merit (Eşleşmedi)' END AS supply_status, count(*) AS n, avg(bid_offer_price_try) AS mean_price FROM supply_demand_curve LEFT JOIN pricing USING (date, hour) WHERE date = (SELECT max(date) FROM supply_demand_curve) GROUP BY 1, 2", "date", "supply_status", "n")
_add("BI13_independent_share", reports.independent_share, "SELECT date, matched_mwh, independent_mwh, independent_mwh / nullif(matched_mwh, 0) * 100 AS share_pct FROM (SELECT date, sum(matched_bids_mwh) AS matched_mwh FROM dam_clearing GROUP BY 1) LEFT JOIN (SELECT date, sum(price_independent_bid_mwh) AS independent_mwh FROM price_ind_bid GROUP BY 1) USING (date)", "date")
_add("BI14_top_companies", reports.top_companies, "SELECT organization_id, organization_name, sum(matched_bids_mwh + matched_offers_mwh) AS total_volume_mwh, sum(matched_bids_mwh - matched_offers_mwh) AS net_position_mwh, count(*) FILTER (matched_bids_mwh > 0 OR matched_offers_mwh > 0) AS active_hours FROM dam_clearing_by_org GROUP BY 1, 2 ORDER BY 3 DESC, 1 LIMIT 10", "organization_id", "organization_name", "active_hours")
_add("BI15_top_producers", reports.top_producers, "SELECT org_id, organization_name, sum(total_kgup_mwh) AS total_kgup_mwh, sum(natural_gas_mwh) AS natural_gas_mwh, sum(wind_mwh) AS wind_mwh, sum(dam_hydro_mwh + river_hydro_mwh) AS hydro_mwh, sum(solar_mwh) AS solar_mwh, sum(lignite_mwh + hard_coal_mwh + imported_coal_mwh) AS coal_mwh FROM kgup_bulk_by_org LEFT JOIN participants ON org_id = organization_id GROUP BY 1, 2 ORDER BY 3 DESC, 1 LIMIT 10", "org_id", "organization_name")
_profile = ", ".join(f"avg({c}) AS mean_{c}" for c in ("forecasted_load_mwh", "forecasted_res_mwh", "forecasted_residual_load_mwh"))
_add("BI16_residual_profile", reports.residual_profile, f"SELECT hour, {_profile}, count(*) AS n FROM ({RESIDUAL}) GROUP BY 1", "hour", "n")
_add("BI16_residual_monthly", reports.residual_monthly, f"SELECT {_month}, {_profile}, count(*) AS n FROM ({RESIDUAL}) GROUP BY 1", "year_month", "n")
_add("BI17_shock_months", lambda lake: reports.shock_months(lake, AS_OF), f"SELECT {_month}, avg(total_outage_mwh) AS mean_outage_mwh, avg(supply_shock_index) AS mean_shock, count(*) FILTER (supply_shock_index > 1) AS risk_days, count(*) AS n FROM ({SHOCK}) GROUP BY 1", "year_month", "risk_days", "n")
_add("BI18_outlook_spine", _predicted(lambda lake, p: reports.outlook_spine(lake, p, NOW)), f"SELECT datetime, smf_try, p AS predicted_smf, coalesce(smf_try, p) AS value, CASE WHEN smf_try IS NOT NULL THEN 'realized' WHEN p IS NOT NULL THEN 'model' ELSE 'none' END AS value_source FROM (SELECT unnest(generate_series(TIMESTAMP '{NOW}' - INTERVAL 7 HOUR, TIMESTAMP '{NOW}' + INTERVAL 16 HOUR, INTERVAL 1 HOUR)) AS datetime) LEFT JOIN (SELECT date::TIMESTAMP + (hour - 3) * INTERVAL 1 HOUR AS datetime, smf_try FROM smf) USING (datetime) LEFT JOIN (SELECT date::TIMESTAMP + (hour - 3) * INTERVAL 1 HOUR AS datetime, p FROM {_told}) USING (datetime)", "datetime", "value_source")
_add("BI19_lag_correlations", reports.lag_correlations, "WITH l AS (SELECT smf_try AS v, lag(smf_try, 5) OVER (ORDER BY date, hour) AS a, lag(smf_try, 24) OVER (ORDER BY date, hour) AS b, lag(smf_try, 168) OVER (ORDER BY date, hour) AS c FROM smf) SELECT 1 AS k, corr(v, a) AS corr_5h, corr(v, b) AS corr_24h, corr(v, c) AS corr_168h FROM l", "k")
ORACLE_SQL["BI19_lag_correlations"] = f"SELECT * EXCLUDE (k) FROM ({ORACLE_SQL['BI19_lag_correlations']})"
_add("BI20_confusion", _predicted(reports.confusion), f"SELECT c AS system_direction, count(*) FILTER (d = 'ENERGY_DEFICIT') AS ENERGY_DEFICIT, count(*) FILTER (d = 'ENERGY_SURPLUS') AS ENERGY_SURPLUS, count(*) FILTER (d = 'IN_BALANCE') AS IN_BALANCE FROM (VALUES ('ENERGY_DEFICIT'), ('ENERGY_SURPLUS'), ('IN_BALANCE')) AS t(c) LEFT JOIN (SELECT system_direction, d FROM {_told} JOIN system_direction USING (date, hour)) ON c = system_direction GROUP BY 1")
_add("BI21_last_week", reports.last_week, "WITH s AS (SELECT (m - d::INT)::DATE AS date, h::INT AS hour FROM (SELECT max(date) AS m FROM smf), range(7) AS a(d), range(24) AS b(h)) SELECT date, hour, smf_try, smf_try IS NULL AS missing FROM s LEFT JOIN smf USING (date, hour)", "date", "hour", "missing")
_add("BI22_unlicensed_totals", reports.unlicensed_totals, "SELECT 1 AS k, sum(u) AS total_mwh, sum(u * p) AS total_value_try, corr(u, p) AS correlation FROM (SELECT date, sum(total_unlicensed_mwh) AS u FROM unlicensed_generation GROUP BY 1) LEFT JOIN (SELECT date, avg(ptf_try) AS p FROM pricing GROUP BY 1) USING (date)", "k")
ORACLE_SQL["BI22_unlicensed_totals"] = f"SELECT * EXCLUDE (k) FROM ({ORACLE_SQL['BI22_unlicensed_totals']})"
_add("BI23_intraday_profile", reports.intraday_profile, "SELECT hour, avg(v) AS mean_gip_vwap_try, avg(q) AS mean_gip_volume_mwh, count(*) AS n FROM (SELECT date, hour, sum(price_try * quantity_mwh) / nullif(sum(quantity_mwh), 0) AS v, sum(quantity_mwh) AS q FROM idm_transactions GROUP BY 1, 2) GROUP BY 1", "hour", "n")
_add("BI23_weather_price", reports.weather_price, f"SELECT 1 AS k, corr(avg_temperature_c, ptf_try) AS corr_avg_temperature_c, corr(avg_windspeed_kmh, ptf_try) AS corr_avg_windspeed_kmh, corr(avg_solar_radiation_wm2, ptf_try) AS corr_avg_solar_radiation_wm2 FROM ({TRADE_WEATHER})", "k")
ORACLE_SQL["BI23_weather_price"] = f"SELECT * EXCLUDE (k) FROM ({ORACLE_SQL['BI23_weather_price']})"
_add("BI23_intraday_months", reports.intraday_months, f"SELECT {_month}, avg(q) AS mean_volume_mwh, sum(q) AS volume_mwh, avg(v) AS mean_vwap_try, sum(c)::BIGINT AS transactions, count(*) AS n FROM (SELECT date, hour, sum(price_try * quantity_mwh) / nullif(sum(quantity_mwh), 0) AS v, sum(quantity_mwh) AS q, count(*) AS c FROM idm_transactions GROUP BY 1, 2) GROUP BY 1", "year_month", "transactions", "n")
_add("BI24_plan_days", reports.plan_days, f"SELECT date, avg(a) AS mean_kgup_total_mwh, avg(b) AS mean_kudup_total_mwh, avg(b - a) AS mean_intraday_revision_mwh, count(*) AS n FROM {_plan} GROUP BY 1", "date", "n")
_add("BI24_revision_counts", reports.revision_counts, f"SELECT CASE WHEN b - a > 50 THEN 'GIP_Alim' WHEN b - a < -50 THEN 'GIP_Satis' ELSE 'Denge' END AS revision_direction, count(*) AS n, avg(b - a) AS mean_revision_mwh FROM {_plan} GROUP BY 1", "revision_direction", "n")
_revised = ", ".join(f"avg(b.{c} - a.{c}) AS mean_{n}_revision_mwh" for n, c in (("wind", "wind_mwh"), ("solar", "solar_mwh"), ("hydro", "dam_hydro_mwh")))
_add("BI24_revision_sources", reports.revision_sources, f"SELECT hour, {_revised}, count(*) AS n FROM sbfgp b FULL JOIN dpp a USING (date, hour) GROUP BY 1", "hour", "n")
_add("BI25_extreme_counts", reports.extreme_counts, f"SELECT ptf_category, extreme_driver, count(*) AS n, avg(ptf_try) AS mean_ptf FROM ({EXTREMES}) GROUP BY 1, 2", "ptf_category", "extreme_driver", "n")
_add("BI25_extreme_months", reports.extreme_months, f"SELECT {_month}, count(*) FILTER (ptf_category = 'MINIMUM') AS minimum, count(*) FILTER (ptf_category = 'TAVAN') AS ceiling FROM ({EXTREMES}) GROUP BY 1", "year_month", "minimum", "ceiling")
_add("BI25_extreme_hours", reports.extreme_hours, "SELECT hour, count(*) FILTER (ptf_try >= b) AS ceiling, count(*) FILTER (ptf_try <= a AND ptf_try < b) AS minimum FROM pricing, (SELECT quantile_disc(ptf_try, 0.05) AS a, quantile_disc(ptf_try, 0.95) AS b FROM pricing) GROUP BY 1")
_add("BI26_cascade_counts", reports.cascade_counts, f"SELECT {_month}, price_cascade, count(*) AS n FROM ({SPREAD}) GROUP BY 1, 2")
_add("BI26_spread_profile", reports.spread_profile, f"SELECT hour, avg(gip_gop_spread_try) AS mean_gip_gop_spread_try, avg(smf_gop_spread_try) AS mean_smf_gop_spread_try, avg(yal_delivered_mwh) AS mean_yal_delivered_mwh, avg(yat_delivered_mwh) AS mean_yat_delivered_mwh, count(*) AS n FROM ({SPREAD}) GROUP BY 1", "hour", "n")
_add("BI26_arbitrage_days", reports.arbitrage_days, f"SELECT date, avg(arbitrage_opportunity_score) AS mean_score, max(arbitrage_opportunity_score) AS max_score, count(*) FILTER (arbitrage_opportunity_score > 0.1) AS high_hours FROM ({SPREAD}) GROUP BY 1", "date", "high_hours")
_add("BI27_error_months", reports.error_months, f"SELECT {_month}, avg(abs(e)) AS mae, avg(e) AS bias, " + ", ".join(f"quantile_cont(e, {q / 100}) AS p{q}" for q in (0, 25, 50, 75, 100)) + f" FROM {_err} GROUP BY 1", "year_month")
_daily = f"SELECT date, round(sqrt(avg(e * e)), 2) AS rmse, round(avg(abs(e) / nullif(a, 0) * 100), 2) AS mape FROM {_err} GROUP BY 1"
_add("BI27_error_kpis", reports.error_kpis, f"SELECT (SELECT avg(rmse) FROM ({_daily})) AS mean_daily_rmse_mwh, (SELECT avg(mape) FROM ({_daily})) AS mean_daily_mape_pct, 100.0 * avg((coalesce(e, 0) > 0)::INT) AS over_forecast_pct, avg(abs(e)) AS mean_abs_error_mwh, count(*) AS n FROM {_err}", "n")
_boxes = ", ".join(f"quantile_disc(e, {q / 100}) AS p{q}" for q in (5, 25, 50, 75, 95))
_add("BI27_error_boxes", lambda lake: reports.error_boxes(lake, folder(lake.silver.spark)), f"SELECT {_month}, count(*) AS n, avg(e) AS bias, {_boxes} FROM {_err} WHERE e IS NOT NULL GROUP BY 1", "year_month", "n")
_add("BI27_error_profile", reports.error_profile, f"SELECT hour, avg(e) AS mean_forecast_error_mwh, avg(abs(e)) AS mean_abs_error_mwh, count(*) AS n FROM {_err} GROUP BY 1", "hour", "n")
_add("BI28_stress_buckets", reports.stress_buckets, f"SELECT date, CASE WHEN i IS NULL THEN 'none' WHEN i < 0.2 THEN 'critical' WHEN i < 0.4 THEN 'low' WHEN i < 0.7 THEN 'normal' ELSE 'high' END AS bucket, count(*) AS n_dams, sum(active_volume) AS volume FROM {_stress} WHERE date = (SELECT max(date) FROM dams) GROUP BY 1, 2", "date", "bucket", "n_dams")
_add("BI28_basin_days", reports.basin_days, f"SELECT date, sum(active_volume) AS volume, avg(i) AS mean_stress FROM {_stress} GROUP BY 1", "date")
_add("BI28_volume_movers", reports.volume_movers, f"SELECT date, dam_id, dam_name, c AS wow_volume_change, c / nullif(l, 0) AS wow_volume_change_pct FROM {_stress} WHERE c / nullif(l, 0) IS NOT NULL ORDER BY 5, 1, 2 LIMIT 10", "date", "dam_id", "dam_name")
_add("BI29_shift_starts", reports.shift_starts, f"SELECT cheapest_8h_start_hour, count(*) AS n_days, avg(max_shift_saving_per_mwh) AS mean_saving FROM ({SHIFTS}) WHERE cheapest_8h_start_hour IS NOT NULL GROUP BY 1", "cheapest_8h_start_hour", "n_days")
_shift_means = ", ".join(f"avg({c}) AS mean_{c}" for c in ("vardiya_00_08_avg_ptf", "vardiya_08_16_avg_ptf", "vardiya_16_24_avg_ptf", "max_shift_saving_per_mwh"))
_add("BI29_shift_months", reports.shift_months, f"SELECT {_month}, {_shift_means}, count(*) AS n FROM ({SHIFTS}) GROUP BY 1", "year_month", "n")
_add("BI30_shift_advice", reports.shift_advice, f"SELECT * FROM ({SHIFTS}) WHERE date = (SELECT max(date) FROM (SELECT date FROM pricing GROUP BY 1 HAVING count(DISTINCT hour) = 24))", "date", "cheapest_8h_start_hour", "priciest_8h_start_hour")
_add("BI31_freshest", reports.freshest, "SELECT max(date) AS freshest FROM pricing")
_add("BI32_smf_days", reports.smf_days, "SELECT date, avg(smf_try) AS mean_smf, avg(r) AS mean_rolling_24h FROM (SELECT *, avg(smf_try) OVER (ORDER BY date, hour ROWS BETWEEN 23 PRECEDING AND CURRENT ROW) AS r FROM smf) GROUP BY 1", "date")

_add("TS1_expected_extremes", lambda lake: marts.prices(lake).join(lake["smf"], ["date", "hour"]).select("date", "hour", signal.expected_max(F.col("smf_try"), F.lit(10.0), F.col("ptf_try")).alias("e_max"), signal.expected_min(F.col("smf_try"), F.lit(10.0), F.col("ptf_try")).alias("e_min")))
_add("TS2_residual_sigma", _predicted(lambda lake, p: signal.residual_sigma(p, lake["smf"])), f"WITH e AS (SELECT d AS predicted_direction, smf_try - p AS e FROM {_told} JOIN smf USING (date, hour)) SELECT predicted_direction, count(*) AS n, CASE WHEN count(*) < 20 THEN (SELECT stddev_samp(e) FROM e) ELSE stddev_samp(e) END AS sigma FROM e GROUP BY 1", "predicted_direction", "n")
_add("TS3_backtest_frame", _predicted(signal.backtest_frame), f"SELECT date, hour, p AS predicted_smf, d AS predicted_direction, smf_try, ptf_try, v AS gip_vwap_try FROM {_told} JOIN smf USING (date, hour) JOIN pricing USING (date, hour) JOIN (SELECT date, hour, sum(price_try * quantity_mwh) / nullif(sum(quantity_mwh), 0) AS v FROM idm_transactions GROUP BY 1, 2) USING (date, hour) WHERE v IS NOT NULL".replace("SELECT date, hour, p AS predicted_smf, d AS predicted_direction, smf_try, ptf_try", "SELECT date, hour, p AS predicted_smf, d AS predicted_direction, smf_try, ptf_try"), "date", "hour", "predicted_direction")
_add("TS4_signals", _predicted(lambda lake, p: signal.with_signals(signal.backtest_frame(lake, p), signal.residual_sigma(p, lake["smf"]))))
_add("TS5_backtest", _predicted(signal.backtest))
_add("TS6_summary", _predicted(lambda lake, p: signal.summary(signal.backtest(lake, p))))
_add("TS8_daily_edge", _predicted(lambda lake, p: signal.daily_edge(signal.backtest(lake, p))))
_add("TS8_win_rate", _predicted(lambda lake, p: signal.win_rate(signal.backtest(lake, p))))
_add("TS9_live_signal", _predicted(lambda lake, p: signal.live_signal(lake, p, AS_OF)))


def _score(lake: Lake) -> DataFrame:
    tables = {"pricing": "ptf_try", "smf": "smf_try", "generation": "total_generation_mwh", "order_up": "net_mwh"}
    one, *rest = [quality.coverage(lake[n], n, v, AS_OF) for n, v in tables.items()]
    for df in rest:
        one = one.unionByName(df)
    return one


def _coverage_sql(name: str, value: str) -> str:
    done = f"round(100.0 * count(DISTINCT (date, hour)) / (24 * (max(date) - min(date) + 1)), 2)"  # noqa: F541
    stale = f"(DATE '{AS_OF}' - max(date))"
    return f"SELECT '{name}' AS table_name, min(date) AS min_date, max(date) AS max_date, count(*) AS n_rows, round(100.0 * count(*) FILTER ({value} IS NULL) / count(*), 2) AS null_pct, round(100.0 * count(*) FILTER ({value} < 0) / count(*), 2) AS low_pct, count(DISTINCT date) AS n_days, count(DISTINCT (date, hour)) AS n_hours, {done} AS completeness_pct, {stale}::INT AS days_stale, CASE WHEN {done} < 80 OR {stale} > 7 THEN 'ERROR' WHEN {done} < 98 OR {stale} > 2 THEN 'WARN' ELSE 'OK' END AS status FROM {name}"


_cover = " UNION ALL ".join(_coverage_sql(n, v) for n, v in {"pricing": "ptf_try", "smf": "smf_try", "generation": "total_generation_mwh", "order_up": "net_mwh"}.items())
_add("DQ1_not_null", lambda lake: quality.not_null(lake["pricing"], "ptf_usd"), "SELECT * FROM pricing WHERE ptf_usd IS NULL", "date", "hour")
_add("DQ2_unique", lambda lake: quality.unique(lake.silver["idm_transactions"], "id"), "SELECT event_id AS id, 2::BIGINT AS n FROM events WHERE event_id % 10 = 0")
_add("DQ3_unique_combination", lambda lake: quality.unique(lake.silver.table("lineitem"), "l_orderkey", "l_linenumber"), "SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1")
_add("DQ4_accepted_values", lambda lake: quality.accepted_values(lake.silver.table("lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_returnflag"), "l_returnflag", ["A", "N"]), "SELECT l_orderkey, l_linenumber, l_partkey, l_returnflag FROM lineitem WHERE l_returnflag NOT IN ('A', 'N')")
_add("DQ5_accepted_range", lambda lake: quality.accepted_range(lake["imbalance"], "net_imbalance_mwh", least=0), "SELECT * FROM imbalance WHERE net_imbalance_mwh < 0", "date", "hour")
_add("DQ6_hourly_gaps", lambda lake: quality.hourly_gaps(lake["pricing"], AS_OF), f"SELECT d::DATE AS date, h::INT AS hour FROM (SELECT unnest(generate_series(min(date), DATE '{AS_OF}' - 3, INTERVAL 1 DAY)) AS d FROM pricing), range(24) AS r(h) WHERE NOT EXISTS (SELECT 1 FROM pricing p WHERE p.date = d::DATE AND p.hour = h)")
_add("DQ7_price_positive", lambda lake: quality.accepted_range(lake["order_up"].select("date", "hour", "net_mwh"), "net_mwh", least=0), "SELECT date, hour, net_mwh FROM order_up WHERE net_mwh < 0", "date", "hour")
_add("DQ8_generation_floor", lambda lake: quality.accepted_range(lake["generation"].select("date", "hour", "total_generation_mwh"), "total_generation_mwh", least=100), "SELECT date, hour, total_generation_mwh FROM generation WHERE total_generation_mwh < 100", "date", "hour")
_add("DQ9_check_results", lambda lake: quality.check_results({("usd_not_null", "warn"): quality.not_null(lake["pricing"], "ptf_usd"), ("trade_unique", "error"): quality.unique(lake["idm_transactions"], "id"), ("load_gaps", "warn"): quality.hourly_gaps(lake["load_estimation"], AS_OF)}), f"SELECT 'usd_not_null' AS \"check\", 'warn' AS severity, count(*) AS failures FROM pricing WHERE ptf_usd IS NULL UNION ALL SELECT 'trade_unique', 'error', count(*) FROM (SELECT id FROM idm_transactions GROUP BY 1 HAVING count(*) > 1) UNION ALL SELECT 'load_gaps', 'warn', count(*) FROM (SELECT unnest(generate_series(min(date), DATE '{AS_OF}' - 3, INTERVAL 1 DAY)) AS d FROM load_estimation), range(24) AS r(h) WHERE NOT EXISTS (SELECT 1 FROM load_estimation p WHERE p.date = d::DATE AND p.hour = h)")
_add("DQ10_freshness", lambda lake: quality.freshness(lake.silver["smf"], "smf", "date", AS_OF, 24, 48), f"SELECT 'smf' AS source, max(t) AS last, date_diff('hour', max(t), TIMESTAMP '{AS_OF}') AS age_hours, CASE WHEN date_diff('hour', max(t), TIMESTAMP '{AS_OF}') > 48 THEN 'error' WHEN date_diff('hour', max(t), TIMESTAMP '{AS_OF}') > 24 THEN 'warn' ELSE 'ok' END AS status FROM slv WHERE sum_purchase IS NOT NULL")
_add("DQ11_coverage", _score, _cover, "table_name", "min_date", "max_date", "n_rows", "n_days", "n_hours", "days_stale", "status")
_add("DQ12_short_days", lambda lake: quality.short_days(lake["pricing"]), "SELECT date, count(*) AS n_rows FROM pricing GROUP BY 1 HAVING count(*) < 24 ORDER BY 2, 1 LIMIT 20")
_add("DQ13_missing_days", lambda lake: quality.missing_days(lake["fx_rates"], AS_OF), f"SELECT (DATE '{AS_OF}' - min(date) + 1 - count(DISTINCT date) FILTER (date <= DATE '{AS_OF}'))::BIGINT AS missing_days FROM fx_rates")
_add("DQ13_missing_days_of_a_dead_feed", lambda lake: quality.missing_days(lake["fx_rates"].where("date < DATE '2024-01-10'"), AS_OF), f"SELECT (DATE '{AS_OF}' - min(date) + 1 - count(DISTINCT date) FILTER (date < DATE '2024-01-10'))::BIGINT AS missing_days FROM fx_rates")
_add("DQ6_hourly_gaps_of_a_dead_feed", lambda lake: quality.hourly_gaps(lake["load_estimation"].where("date <= DATE '2024-01-10'"), AS_OF), f"SELECT d::DATE AS date, h::INT AS hour FROM (SELECT unnest(generate_series(min(date), DATE '{AS_OF}' - 3, INTERVAL 1 DAY)) AS d FROM load_estimation), range(24) AS r(h) WHERE NOT EXISTS (SELECT 1 FROM load_estimation p WHERE p.date <= DATE '2024-01-10' AND p.date = d::DATE AND p.hour = h)")
_add("DQ14_mart_health", lambda lake: quality.mart_health({"ptf_usd": marts.ptf_usd(lake), "hydro_risk": marts.hydro_risk(lake)}, AS_OF), f"SELECT 'ptf_usd' AS mart, count(*) AS n_rows, min(date) AS min_date, max(date) AS max_date, CASE WHEN DATE '{AS_OF}' - max(date) > 3 THEN 'STALE' ELSE 'OK' END AS status FROM pricing WHERE ptf_usd IS NOT NULL UNION ALL SELECT 'hydro_risk', count(*), min(date), max(date), CASE WHEN DATE '{AS_OF}' - max(date) > 3 THEN 'STALE' ELSE 'OK' END FROM dams")
_add("DQ15_price_sanity", lambda lake: quality.price_sanity(lake["pricing"]), "SELECT avg(ptf_try) AS avg_price, min(ptf_try) AS min_price, max(ptf_try) AS max_price, stddev_samp(ptf_try) AS std_price, count(*) FILTER (ptf_try <= 0) AS not_positive, count(*) FILTER (ptf_try > 10000) AS above_ceiling FROM pricing", "not_positive", "above_ceiling")
_add("DQ16_city_coverage", lambda lake: quality.group_coverage(lake["weather"], "city_name"), "SELECT city_name, count(*) AS n_rows, count(DISTINCT date) AS n_days, min(date) AS min_date, max(date) AS max_date FROM weather GROUP BY 1")
_add("DQ17_event_coverage", lambda lake: quality.day_coverage(lake["outages"]), "SELECT count(DISTINCT date) AS n_days, (max(date) - min(date) + 1)::INT AS expected, round(100.0 * count(DISTINCT date) / (max(date) - min(date) + 1), 2) AS coverage_pct FROM outages", "n_days", "expected")
_add("DQ18_score_card", lambda lake: quality.score_card(_score(lake)), f"SELECT count(*) FILTER (status = 'OK') AS n_ok, count(*) FILTER (status = 'WARN') AS n_warn, count(*) FILTER (status = 'ERROR') AS n_error, round(avg(completeness_pct) FILTER (completeness_pct <= 110), 2) AS mean_completeness FROM ({_cover})", "n_ok", "n_warn", "n_error")
_add("DQ19_cross_partition_duplicates", lambda lake: quality.cross_partition_duplicates(lake.silver["idm_transactions"], ["id"], F.to_date("date")), "SELECT event_id AS id, 2::BIGINT AS partitions FROM events WHERE event_id % 10 = 0 AND hour(ts) = 23")
