"""DuckDB SQL twins of the staged tables and marts, over the same test tables."""

from __future__ import annotations

from ..sources.bindings import BANDS, GENERATION_FUELS, PLAN_FUELS, SCALE, TYPES, YEARS_ON
from ..sources.bindings import UNLICENSED as UNLICENSED_FUELS
from .staging import CAPACITY, GENERATION, UNLICENSED, plan_columns

AS_OF = "2024-01-31"
_sums = ", ".join([f"sum(value) FILTER (event_type = '{t}') AS sum_{t}" for t in TYPES] + [f"avg(value) FILTER (event_type = '{t}') AS avg_{t}" for t in ("view", "purchase")])
_bands = ", ".join(f"sum(value) FILTER (k % {BANDS} = {i}) AS band{i}" for i in range(BANDS))
_coded = ", ".join(f"sum(value) FILTER (event_type = '{t}' AND k % 3 = {i}) AS {t}{i}" for t in ("error", "click") for i in range(3))
_one = "QUALIFY row_number() OVER (PARTITION BY date, hour ORDER BY t DESC, h DESC) = 1"


def _from_bands(names: dict[str, str], fuels: list[str], total: str, factor: str) -> str:
    at = {f: f"band{i}" for i, f in enumerate(fuels)} | {total: "every"}
    return ", ".join(f"{at[old]} * {factor} AS {new}" for new, old in names.items() if old in at)


def _order(kind: str, side: str) -> str:
    coded = ", ".join(f"sum({kind}{i}) AS {side}_regulation_{n}_mwh" for i, n in enumerate(("zero", "one", "two")))
    return f"SELECT date, hour, {coded}, sum(sum_{kind} * 0.8) AS {side}_regulation_delivered_mwh, sum(sum_{kind} - every * 0.1) AS net_mwh FROM slv WHERE sum_{kind} IS NOT NULL GROUP BY 1, 2"


_net = "round(coalesce(sum_click, 0) + coalesce(sum_signup, 0) - coalesce(sum_view, 0) - coalesce(sum_purchase, 0), 3)"
_ship = f"l_shipdate + INTERVAL {YEARS_ON} YEAR"
_line_hash = "md5(l_orderkey::VARCHAR || '|' || l_linenumber || '|' || l_partkey || '|' || l_suppkey || '|' || l_quantity::INT)"
_kgup = ", ".join(f"CASE WHEN l_linenumber % {len(PLAN_FUELS)} = {PLAN_FUELS.index(old)} THEN l_quantity ELSE 0 END AS {new}" for new, old in plan_columns("x").items() if old in PLAN_FUELS)

TABLES = {
    "ev": f"SELECT event_id, ts, user_id, event_type, value * {SCALE} AS value, json_extract_string(props, '$.k')::INT AS k FROM events",
    "slv": f"SELECT date_trunc('hour', ts) AS t, user_id % 2 AS parity, (date_trunc('hour', ts) + INTERVAL 3 HOUR)::DATE AS date, hour(date_trunc('hour', ts) + INTERVAL 3 HOUR)::INT AS hour, md5(epoch(date_trunc('hour', ts))::BIGINT::VARCHAR || '|' || (user_id % 2)::VARCHAR) AS h, sum(value) AS every, {_sums}, {_bands}, {_coded} FROM ev GROUP BY 1, 2, 3, 4, 5",
    "pricing": f"SELECT date, hour, avg_view AS ptf_try, CASE WHEN hour(t) % 6 <> 5 THEN avg_view / 32 END AS ptf_usd, avg_view / 35 AS ptf_eur FROM slv WHERE sum_view IS NOT NULL {_one}",
    "interim_mcp": f"SELECT date, hour, coalesce(avg_view, avg_purchase, 50.0) * 1.01 AS interim_ptf_try FROM slv WHERE sum_click IS NOT NULL AND parity = 0 {_one}",
    "smf": f"SELECT date, hour, avg_purchase AS smf_try FROM slv WHERE sum_purchase IS NOT NULL {_one}",
    "load_vs_actual": "SELECT t::DATE AS date, hour, every * 0.98 AS actual_consumption FROM slv QUALIFY row_number() OVER (PARTITION BY t::DATE, hour ORDER BY t DESC, h DESC) = 1",
    "load_estimation": f"SELECT date, hour, every AS forecasted_load_mwh FROM slv {_one}",
    "res_forecast": "SELECT date, hour, avg(sum_signup) AS forecasted_res_mwh, avg(sum_click) AS actual_res_generation_mwh FROM slv WHERE sum_signup IS NOT NULL OR sum_click IS NOT NULL GROUP BY 1, 2",
    "generation": f"SELECT date, hour, {_from_bands(GENERATION, GENERATION_FUELS, 'total', '1.0')} FROM slv {_one}",
    "aic": f"SELECT date, hour, {_from_bands(CAPACITY, PLAN_FUELS[:-1], 'toplam', '2.0')} FROM slv {_one}",
    "dpp": f"SELECT date, hour, {_from_bands(plan_columns('total_planned_mwh'), PLAN_FUELS, 'toplam', '1.0')} FROM slv WHERE sum_view IS NOT NULL {_one}",
    "sbfgp": f"SELECT date, hour, {_from_bands(plan_columns('total_kgup_mwh'), PLAN_FUELS, 'toplam', '1.05')} FROM slv WHERE parity = 1",
    "unlicensed_generation": f"SELECT date, hour, {_from_bands(UNLICENSED, UNLICENSED_FUELS, 'toplam', '0.1')} FROM slv WHERE sum_click IS NOT NULL {_one}",
    "imbalance": f"SELECT date, hour, coalesce(sum_click, 0) + coalesce(sum_signup, 0) AS total_generation_mwh, coalesce(sum_view, 0) + coalesce(sum_purchase, 0) AS total_consumption_mwh, {_net} AS net_imbalance_mwh FROM slv {_one}",
    "system_direction": f"SELECT date, hour, CASE WHEN {_net} < 0 THEN 'ENERGY_DEFICIT' WHEN {_net} > 0 THEN 'ENERGY_SURPLUS' ELSE 'IN_BALANCE' END AS system_direction FROM slv WHERE sum_view IS NOT NULL OR sum_click IS NOT NULL {_one}",
    "order_up": _order("error", "up"),
    "order_down": _order("click", "down"),
    "price_ind_bid": f"SELECT date, hour, sum_view * 0.5 AS price_independent_bid_mwh FROM slv WHERE sum_view IS NOT NULL {_one}",
    "dam_clearing": f"SELECT date, hour, coalesce(sum_view, 0) + coalesce(sum_click, 0) AS matched_bids_mwh, coalesce(sum_purchase, 0) + coalesce(sum_signup, 0) AS matched_offers_mwh FROM slv {_one}",
    "idm_transactions": """SELECT (came + INTERVAL 3 HOUR)::DATE AS date, hour(came + INTERVAL 3 HOUR)::INT AS hour, event_id::VARCHAR AS id, event_type AS contract_name, value AS price_try, (1 + k % 10)::DOUBLE AS quantity_mwh
        FROM (SELECT *, ts AS came FROM ev UNION ALL SELECT *, ts + INTERVAL 1 HOUR FROM ev WHERE event_id % 10 = 0) QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY came DESC) = 1""",
    "weather": "SELECT (date_trunc('hour', ts) + INTERVAL 3 HOUR)::DATE AS date, hour(date_trunc('hour', ts) + INTERVAL 3 HOUR)::INT AS hour, 'city' || (user_id % 4) AS city_name, avg(value) AS temperature_celsius, max(value) AS wind_speed_kmh, sum(value) AS shortwave_radiation, min(value) AS relative_humidity FROM ev GROUP BY 1, 2, 3",
    "outages": f"""SELECT s::DATE AS date, id::VARCHAR AS id, s AS start_time, least({_ship}, s + INTERVAL 30 DAY) AS end_time, 'org' || l_suppkey AS company_name, 'plant' || l_partkey AS plant_name, l_quantity * 2 AS installed_capacity_mwh, l_quantity AS outage_capacity_mwh, 'reason' || l_linenumber AS outage_reason
        FROM (SELECT *, o_orderdate + INTERVAL {YEARS_ON} YEAR AS s, l_orderkey * 10 + l_linenumber AS id, {_line_hash} AS h FROM lineitem JOIN orders ON l_orderkey = o_orderkey) QUALIFY row_number() OVER (PARTITION BY id ORDER BY s DESC, h DESC) = 1""",
    "dams": f"SELECT ({_ship})::DATE AS date, l_suppkey AS dam_id, any_value(r_name) AS basin_name, any_value(s_name) AS dam_name, sum(l_quantity) AS active_volume FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY 1, 2",
    "lines": f"SELECT *, ({_ship})::DATE AS date, (l_partkey % 24)::INT AS hour, {_line_hash} AS h FROM lineitem JOIN supplier ON l_suppkey = s_suppkey",
    "dam_clearing_by_org": "SELECT date, hour, l_suppkey AS organization_id, s_name AS organization_name, CASE WHEN l_returnflag = 'A' THEN l_quantity ELSE 0 END AS matched_bids_mwh, CASE WHEN l_returnflag = 'A' THEN 0 ELSE l_quantity END AS matched_offers_mwh FROM lines QUALIFY row_number() OVER (PARTITION BY date, hour, l_suppkey ORDER BY h DESC) = 1",
    "kgup_bulk_by_org": f"SELECT date, hour, l_suppkey AS org_id, l_partkey AS uevcb_id, 'unit' || l_partkey AS uevcb_name, l_quantity AS total_kgup_mwh, {_kgup} FROM lines QUALIFY row_number() OVER (PARTITION BY date, hour, l_suppkey, l_partkey ORDER BY h DESC) = 1",
    "supply_demand_curve": "SELECT (DATE '2024-01-01' + (p_partkey % 30)::INT)::DATE AS date, (p_size % 24)::INT AS hour, p_retailprice AS bid_offer_price_try, p_size * 10.0::DOUBLE AS cumulative_supply_mwh, 600.0::DOUBLE - p_size * 10 AS cumulative_demand_mwh FROM part QUALIFY row_number() OVER (PARTITION BY p_partkey % 30, p_size % 24, p_retailprice ORDER BY md5(p_partkey::VARCHAR) DESC) = 1",
    "fx_rates": f"SELECT (o_orderdate + INTERVAL {YEARS_ON} YEAR)::DATE AS date, avg(o_totalprice) / 5000 AS usdtry, false AS is_ffilled FROM orders WHERE isodow(o_orderdate + INTERVAL {YEARS_ON} YEAR) < 6 GROUP BY 1",
    "participants": "SELECT s_suppkey AS organization_id, s_name AS organization_name, 'C' || s_suppkey AS organization_code, 'E' || s_suppkey AS eic_code, CASE WHEN s_acctbal > 0 THEN 'A' ELSE 'B' END AS legal_status FROM supplier",
}


def twin(body: str, *exact: str, rounded: bool = True) -> str:
    """A query over the staged tables; all columns but the exact ones are rounded like the Spark side."""
    tables = ", ".join(f"{n} AS ({sql})" for n, sql in TABLES.items())
    keys = ", ".join(exact)
    if not rounded:
        return f"WITH {tables} SELECT * FROM ({body})"
    return f"WITH {tables} SELECT {keys}, round(COLUMNS(* EXCLUDE ({keys})), 4) + 0.0 FROM ({body})"


def _hours(left: str, *rights: str) -> str:
    return left + "".join(f" LEFT JOIN {r} USING (date, hour)" for r in rights)


_season = "CASE WHEN month({0}) IN (12, 1, 2) THEN 'Kış' WHEN month({0}) IN (3, 4, 5) THEN 'İlkbahar' WHEN month({0}) IN (6, 7, 8) THEN 'Yaz' ELSE 'Sonbahar' END"
_deficit = "CASE WHEN ptf_try IS NOT NULL THEN greatest(ptf_try, coalesce(smf_try, ptf_try)) END * 1.03"
_surplus = "CASE WHEN ptf_try IS NOT NULL THEN least(ptf_try, coalesce(smf_try, ptf_try)) END * 0.97"
_at = "(date::TIMESTAMP + hour * INTERVAL 1 HOUR - INTERVAL 3 HOUR)"
_vwap = "sum(price_try * quantity_mwh) / nullif(sum(quantity_mwh), 0)"
_total = lambda *cs: " + ".join(f"coalesce({c}, 0)" for c in cs)

SPREAD = f"""
WITH gip AS (SELECT date, hour, {_vwap} AS v, avg(price_try) AS a, sum(quantity_mwh) AS q, count(*) AS n, min(price_try) AS lo, max(price_try) AS hi FROM idm_transactions GROUP BY 1, 2),
reg AS (SELECT u.date, u.hour, coalesce(u.up_regulation_delivered_mwh, 0) AS yal, coalesce(d.down_regulation_delivered_mwh, 0) AS yat FROM order_up u LEFT JOIN order_down d USING (date, hour)),
sys AS (SELECT * FROM system_direction LEFT JOIN (SELECT date, hour, net_imbalance_mwh FROM imbalance) USING (date, hour))
SELECT date, hour, ptf_try AS gop_ptf_try, v AS gip_vwap_try, a AS gip_avg_price_try, smf_try AS dgp_smf_try, v - ptf_try AS gip_gop_spread_try, smf_try - ptf_try AS smf_gop_spread_try, smf_try - v AS smf_gip_spread_try,
  abs(v - ptf_try) AS gip_gop_spread_abs, abs(v - ptf_try) / nullif(ptf_try, 0) * 100 AS gip_gop_spread_pct,
  CASE WHEN v > ptf_try AND smf_try > v THEN 'ESCALATING' WHEN v < ptf_try AND smf_try < v THEN 'DESCENDING' WHEN v > ptf_try AND smf_try < v THEN 'GIP_PEAK' WHEN v < ptf_try AND smf_try > v THEN 'GIP_TROUGH' ELSE 'FLAT' END AS price_cascade,
  CASE WHEN (system_direction = 'ENERGY_DEFICIT' AND v > ptf_try) OR (system_direction = 'ENERGY_SURPLUS' AND v < ptf_try) THEN abs(v - ptf_try) / nullif(ptf_try, 0) ELSE 0 END AS arbitrage_opportunity_score,
  system_direction, coalesce(net_imbalance_mwh, 0) AS net_imbalance_mwh, coalesce(yal, 0) AS yal_delivered_mwh, coalesce(yat, 0) AS yat_delivered_mwh, coalesce(yal - yat, 0) AS net_dgp_mwh,
  coalesce(q, 0) AS gip_total_volume_mwh, coalesce(n, 0) AS gip_transaction_count, lo AS gip_min_price_try, hi AS gip_max_price_try, hi - lo AS gip_price_range_try
FROM {_hours("pricing", "gip", "smf", "sys", "reg")}"""
SHOCK = f"""
WITH days AS (SELECT unnest(generate_series(start_time::DATE, least(end_time::DATE, DATE '{AS_OF}'), INTERVAL 1 DAY))::DATE AS date, outage_capacity_mwh FROM outages WHERE end_time > start_time AND start_time::DATE <= DATE '{AS_OF}'),
lost AS (SELECT date, sum(outage_capacity_mwh) AS total_outage_mwh FROM days GROUP BY 1), have AS (SELECT date, sum(total_aic_mwh) AS total_available_capacity_mwh FROM aic GROUP BY 1)
SELECT date, total_outage_mwh, total_available_capacity_mwh, total_outage_mwh / nullif(total_available_capacity_mwh, 0) AS supply_shock_index FROM lost LEFT JOIN have USING (date)"""
ANALYSIS = f"""
SELECT date, hour, ptf_try, smf_try, ptf_try - coalesce(smf_try, ptf_try) AS price_spread, {_season.format("date")} AS season, CASE WHEN hour BETWEEN 17 AND 21 THEN 'Puant' WHEN hour BETWEEN 6 AND 16 THEN 'Gündüz' ELSE 'Gece' END AS price_block,
  round({_deficit}, 4) AS deficit_settlement_price, round({_surplus}, 4) AS surplus_settlement_price, round(ptf_try / 4500.0 * 100.0, 2) AS cap_proximity_pct, ptf_try = 0 AS is_zero_price, round(max(ptf_try) OVER (PARTITION BY date) - min(ptf_try) OVER (PARTITION BY date), 4) AS daily_ptf_range
FROM {_hours("pricing", "smf")}"""
RESIDUAL = f"""
SELECT date, hour, {_at} AS datetime, forecasted_load_mwh, forecasted_res_mwh, ptf_try, price_independent_bid_mwh, forecasted_load_mwh - forecasted_res_mwh AS forecasted_residual_load_mwh
FROM {_hours("load_estimation", "res_forecast", "pricing", "price_ind_bid")}"""
REALIZED = f"SELECT date, hour, {_at} AS datetime, coalesce(ptf_try, interim_ptf_try) AS ptf_try, CASE WHEN ptf_try IS NOT NULL THEN 'final' ELSE 'interim' END AS price_status FROM (SELECT date, hour, ptf_try FROM pricing) FULL JOIN interim_mcp USING (date, hour)"
FEATURES = f"""
WITH cl AS (SELECT date + 1 AS date, hour, gip_gop_spread_try, arbitrage_opportunity_score, yal_delivered_mwh, yat_delivered_mwh, net_dgp_mwh FROM ({SPREAD})),
lost AS (SELECT date, total_outage_mwh FROM ({SHOCK})),
gd AS (SELECT date, avg(a) AS avg_gip_price_try, sum(q) AS total_gip_volume_mwh FROM (SELECT date, hour, contract_name, avg(price_try) AS a, sum(quantity_mwh) AS q FROM idm_transactions GROUP BY 1, 2, 3) GROUP BY 1),
fx AS (SELECT date, usdtry, lag(usdtry) OVER (ORDER BY date) AS l1, lag(usdtry, 7) OVER (ORDER BY date) AS l7 FROM fx_rates),
w AS (SELECT date, hour, avg(temperature_celsius) AS temperature_celsius, avg(wind_speed_kmh) AS wind_speed_kmh, avg(shortwave_radiation) AS shortwave_radiation, avg(relative_humidity) AS relative_humidity FROM weather GROUP BY 1, 2),
g AS (SELECT date, hour, coalesce(wind_generation_mwh, 0) AS wi, coalesce(solar_generation_mwh, 0) AS so, {_total("dam_generation_mwh", "river_generation_mwh")} AS hy, coalesce(gas_generation_mwh, 0) AS ga, total_generation_mwh AS tg FROM generation),
cap AS (SELECT date, hour, total_aic_mwh FROM aic), imb AS (SELECT date, hour, net_imbalance_mwh FROM imbalance), rf AS (SELECT date, hour, forecasted_res_mwh FROM res_forecast)
SELECT date, hour, ptf_try, smf_try, smf_try - ptf_try AS ptf_smf_spread, forecasted_load_mwh, forecasted_res_mwh, forecasted_load_mwh - forecasted_res_mwh AS forecasted_residual_load_mwh,
  coalesce(matched_bids_mwh, 0) AS gop_matched_bids_mwh, coalesce(matched_offers_mwh, 0) AS gop_matched_offers_mwh, coalesce(matched_bids_mwh - matched_offers_mwh, 0) AS gop_volume_imbalance_mwh, coalesce(total_outage_mwh, 0) AS total_outage_mwh, coalesce(total_aic_mwh, 0) AS total_aic_mwh,
  (forecasted_load_mwh - forecasted_res_mwh) / nullif(total_aic_mwh, 0) AS capacity_utilization_ratio, coalesce(wi + so + hy, 0) AS actual_renewable_mwh, coalesce((wi + so + hy) / nullif(tg, 0), 0) AS actual_renewable_ratio, coalesce(wi, 0) AS wind_generation_mwh, coalesce(so, 0) AS solar_generation_mwh,
  coalesce(hy, 0) AS hydro_generation_mwh, coalesce(ga, 0) AS gas_generation_mwh, coalesce(tg, 0) AS total_generation_mwh, coalesce(net_imbalance_mwh, 0) AS net_imbalance_mwh, avg_gip_price_try, total_gip_volume_mwh, avg_gip_price_try - ptf_try AS gip_gop_price_spread,
  gip_gop_spread_try AS gip_gop_spread_lag24, arbitrage_opportunity_score AS arb_score_lag24, coalesce(yal_delivered_mwh, 0) AS yal_lag24, coalesce(yat_delivered_mwh, 0) AS yat_lag24, coalesce(net_dgp_mwh, 0) AS net_dgp_lag24, actual_consumption AS actual_consumption_mwh, actual_consumption - forecasted_load_mwh AS consumption_error_mwh,
  temperature_celsius, wind_speed_kmh, shortwave_radiation, relative_humidity, (dayofweek(date) + 1)::INT AS day_of_week, month(date)::INT AS month, year(date)::INT AS year, coalesce(usdtry, 0) AS usdtry, l1 AS usdtry_lag_1d, l7 AS usdtry_lag_7d, (usdtry - l1) / nullif(l1, 0) AS usdtry_pct_change_1d
FROM {_hours("pricing", "smf", "load_estimation", "rf", "dam_clearing", "cap", "g", "imb", "load_vs_actual", "w", "cl")} LEFT JOIN lost USING (date) LEFT JOIN gd USING (date) LEFT JOIN fx USING (date)"""


def _side(name: str, s: str) -> str:
    every = _total(*[f"{s}_regulation_{b}_mwh" for b in ("zero", "one", "two")])
    return f"SELECT *, {every} AS {s}_total_offered_mwh, {s}_regulation_delivered_mwh / nullif({every}, 0) AS {s}_activation_rate FROM (SELECT * RENAME (net_mwh AS {s}_net_mwh) FROM {name})"


_dgp = ", ".join(f"coalesce({long}_regulation_{a}_mwh, 0) AS {short}_{b}_mwh" for long, short in (("up", "yal"), ("down", "yat")) for a, b in (("delivered", "delivered"), ("zero", "zero_price"), ("one", "one_coded"), ("two", "two_coded")))
_up, _down = "coalesce(up_regulation_delivered_mwh, 0)", "coalesce(down_regulation_delivered_mwh, 0)"
DGP = f"""SELECT date, hour, {_dgp}, coalesce(u, 0) AS yal_net_mwh, coalesce(d, 0) AS yat_net_mwh, {_up} - {_down} AS net_dgp_mwh, coalesce(up_regulation_zero_mwh, 0) / nullif({_up}, 0) AS zero_price_ratio_yal,
  coalesce(down_regulation_zero_mwh, 0) / nullif({_down}, 0) AS zero_price_ratio_yat, {_up} + {_down} AS total_regulation_mwh
FROM (SELECT * RENAME (net_mwh AS u) FROM order_up) FULL JOIN (SELECT * RENAME (net_mwh AS d) FROM order_down) USING (date, hour)"""
_fade = lambda c: f"exp(-lead_hours / 5.0) * {c} + (1 - exp(-lead_hours / 5.0)) * avg168"
_fuel_ratios = ", ".join(f"{f}_aic_mwh, {f}_generation_mwh, {f}_generation_mwh / nullif({f}_aic_mwh, 0) AS {n}_utilization_ratio" for f, n in {"total": "total", "gas": "gas", "wind": "wind", "solar": "solar", "lignite": "lignite", "imported_coal": "imported_coal", "geothermal": "geothermal", "dam": "dam_hydro", "river": "run_of_river", "biomass": "biomass"}.items())
_green = ["wind_generation_mwh", "solar_generation_mwh", "dam_generation_mwh", "river_generation_mwh", "geothermal_generation_mwh", "biomass_generation_mwh"]
_fossil = [f"{f}_generation_mwh" for f in ("gas", "lignite", "imported_coal", "black_coal", "asphaltite_coal", "fueloil", "naphtha", "lng")]
_h = ("date", "hour")

EXTREMES = f"""WITH st AS (SELECT quantile_disc(ptf_try, 0.05) AS p5_ptf, quantile_disc(ptf_try, 0.95) AS p95_ptf, avg(ptf_try) AS avg_ptf FROM pricing), cap AS (SELECT date, hour, total_aic_mwh FROM aic), imb AS (SELECT date, hour, net_imbalance_mwh FROM imbalance),
        h AS (SELECT date, hour, ptf_try, smf_try, smf_try - ptf_try AS smf_ptf_spread, forecasted_load_mwh, forecasted_res_mwh, forecasted_load_mwh - forecasted_res_mwh AS residual_load_mwh, total_aic_mwh, (forecasted_load_mwh - forecasted_res_mwh) / nullif(total_aic_mwh, 0) AS capacity_utilization_ratio, system_direction, net_imbalance_mwh FROM {_hours("pricing", "smf", "load_estimation", "res_forecast", "cap", "system_direction", "imb")})
        SELECT h.*, st.*, CASE WHEN ptf_try >= p95_ptf THEN 'TAVAN' WHEN ptf_try <= p5_ptf THEN 'MINIMUM' ELSE 'NORMAL' END AS ptf_category, CASE WHEN ptf_try >= p95_ptf AND capacity_utilization_ratio > 0.9 THEN 'Kapasite_Stresi' WHEN ptf_try >= p95_ptf AND system_direction = 'ENERGY_DEFICIT' THEN 'Sistem_Acigi' WHEN ptf_try >= p95_ptf THEN 'Diger_Tavan'
          WHEN ptf_try <= p5_ptf AND residual_load_mwh < 0 THEN 'RES_Fazlasi' WHEN ptf_try <= p5_ptf AND system_direction = 'ENERGY_SURPLUS' THEN 'Uretim_Fazlasi' WHEN ptf_try <= p5_ptf THEN 'Diger_Minimum' END AS extreme_driver FROM h, st"""
SHIFTS = """WITH s AS (SELECT date, avg(ptf_try) FILTER (hour < 8) AS vardiya_00_08_avg_ptf, avg(ptf_try) FILTER (hour BETWEEN 8 AND 15) AS vardiya_08_16_avg_ptf, avg(ptf_try) FILTER (hour > 15) AS vardiya_16_24_avg_ptf FROM pricing GROUP BY 1),
        w AS (SELECT date, hour, avg(ptf_try) OVER f AS m, count(*) OVER f AS n FROM pricing WINDOW f AS (PARTITION BY date ORDER BY hour ROWS BETWEEN CURRENT ROW AND 7 FOLLOWING)),
        c AS (SELECT date, hour AS cheapest_8h_start_hour, m AS cheapest_8h_avg_ptf FROM w WHERE n = 8 QUALIFY row_number() OVER (PARTITION BY date ORDER BY m, hour) = 1), p AS (SELECT date, hour AS priciest_8h_start_hour, m AS priciest_8h_avg_ptf FROM w WHERE n = 8 QUALIFY row_number() OVER (PARTITION BY date ORDER BY m DESC, hour) = 1)
        SELECT *, round(priciest_8h_avg_ptf - cheapest_8h_avg_ptf, 2) AS max_shift_saving_per_mwh FROM s LEFT JOIN c USING (date) LEFT JOIN p USING (date)"""
TRADE_WEATHER = f"SELECT date, total_gip_volume_mwh, gip_weighted_avg_price_try, total_transaction_count, ptf_try, gip_weighted_avg_price_try - ptf_try AS gip_ptf_spread_try, avg_temperature_c, avg_windspeed_kmh, avg_solar_radiation_wm2 FROM (SELECT date, sum(quantity_mwh) AS total_gip_volume_mwh, {_vwap} AS gip_weighted_avg_price_try, count(*) AS total_transaction_count FROM idm_transactions GROUP BY 1) LEFT JOIN (SELECT date, avg(ptf_try) AS ptf_try FROM pricing GROUP BY 1) USING (date) LEFT JOIN (SELECT date, avg(temperature_celsius) AS avg_temperature_c, avg(wind_speed_kmh) AS avg_windspeed_kmh, avg(shortwave_radiation) AS avg_solar_radiation_wm2 FROM weather GROUP BY 1) USING (date)"
MIX = f"SELECT date, hour, total_generation_mwh AS total_generation, ({_total(*_green)}) / nullif(total_generation_mwh, 0) AS renewable_ratio, ({_total(*_fossil)}) / nullif(total_generation_mwh, 0) AS fossil_ratio FROM generation"


MART_TWINS: dict[str, str] = {
    "MA-1": twin(f"SELECT date, hour, {_fuel_ratios}, lng_generation_mwh, asphaltite_coal_generation_mwh, black_coal_generation_mwh, waste_heat_generation_mwh, import_export_mwh FROM aic FULL JOIN generation USING (date, hour)", *_h),
    "MA-2": twin("SELECT date AS trade_date, organization_id, organization_name, sum(matched_bids_mwh) AS total_bids_mwh, sum(matched_offers_mwh) AS total_offers_mwh, sum(matched_bids_mwh - matched_offers_mwh) AS net_position_mwh, sum(matched_bids_mwh + matched_offers_mwh) AS total_volume_mwh, count(*) FILTER (matched_bids_mwh > 0 OR matched_offers_mwh > 0) AS active_hours FROM dam_clearing_by_org GROUP BY 1, 2, 3", "trade_date", "organization_id", "organization_name", "active_hours"),
    "MA-3": twin("SELECT date AS trade_date, org_id, any_value(organization_name) AS organization_name, count(DISTINCT uevcb_id) AS active_uevcb_count, sum(total_kgup_mwh) AS total_kgup_mwh, sum(natural_gas_mwh) AS natural_gas_mwh, sum(wind_mwh) AS wind_mwh, sum(dam_hydro_mwh + river_hydro_mwh) AS hydro_mwh, sum(solar_mwh) AS solar_mwh, sum(lignite_mwh + hard_coal_mwh + imported_coal_mwh) AS coal_mwh FROM kgup_bulk_by_org LEFT JOIN participants ON org_id = organization_id GROUP BY 1, 2", "trade_date", "org_id", "organization_name", "active_uevcb_count"),
    "MA-4": twin(SPREAD, *_h, "price_cascade", "system_direction", "gip_transaction_count"),
    "MA-5": twin(DGP, *_h),
    "MA-6": twin(DGP, *_h),
    "MA-7": twin("""WITH j AS (SELECT date, hour, forecasted_res_mwh, w + s AS actual_res_mwh, w AS wind_mwh, s AS solar_mwh, actual_res_generation_mwh AS published_actual_res_mwh FROM res_forecast FULL JOIN (SELECT date, hour, coalesce(wind_generation_mwh, 0) AS w, coalesce(solar_generation_mwh, 0) AS s FROM generation) USING (date, hour)),
        e AS (SELECT *, forecasted_res_mwh - actual_res_mwh AS forecast_error_mwh, abs(forecasted_res_mwh - actual_res_mwh) AS abs_error_mwh, abs(forecasted_res_mwh - actual_res_mwh) / nullif(actual_res_mwh, 0) * 100 AS error_pct, CASE WHEN forecasted_res_mwh > actual_res_mwh THEN 'Aşırı Tahmin' WHEN forecasted_res_mwh < actual_res_mwh THEN 'Eksik Tahmin' ELSE 'Eşleşme' END AS error_direction FROM j)
        SELECT *, round(sqrt(avg(forecast_error_mwh ** 2) OVER (PARTITION BY date)), 2) AS daily_rmse_mwh, round(avg(error_pct) OVER (PARTITION BY date), 2) AS daily_mape_pct FROM e""", *_h, "error_direction"),
    "MA-8": twin(RESIDUAL, *_h, "datetime"),
    "MA-9": twin(MIX, *_h),
    "MA-10": twin("SELECT date AS trade_date, hour, contract_name, count(*) AS total_transaction_count, avg(price_try) AS avg_transaction_price_try, sum(quantity_mwh) AS total_volume_mwh, sum(price_try * quantity_mwh) AS total_transaction_value_try FROM idm_transactions GROUP BY 1, 2, 3", "trade_date", "hour", "contract_name", "total_transaction_count"),
    "MA-11": twin(f"SELECT date, hour, {_vwap} AS gip_vwap_try, sum(quantity_mwh) AS gip_volume_mwh, count(*) AS gip_transaction_count FROM idm_transactions GROUP BY 1, 2", *_h, "gip_transaction_count"),
    "MA-12": twin(f"""WITH b AS (SELECT year(date)::INT AS year, month(date)::INT AS month, round(avg(ptf_try), 2) AS avg_ptf, round(max(ptf_try), 2) AS max_ptf, round(min(ptf_try), 2) AS min_ptf, round(avg(price_spread), 2) AS avg_price_spread, count(*) FILTER (system_direction = 'ENERGY_DEFICIT') AS energy_deficit_hours, count(*) FILTER (system_direction = 'ENERGY_SURPLUS') AS energy_surplus_hours FROM ({ANALYSIS}) LEFT JOIN system_direction USING (date, hour) GROUP BY 1, 2),
        f AS (SELECT year(date)::INT AS year, month(date)::INT AS month, round(avg(forecasted_load_mwh), 2) AS avg_forecast_consumption FROM ({RESIDUAL}) GROUP BY 1, 2)
        SELECT *, year || '-' || lpad(month::VARCHAR, 2, '0') AS year_month, {_season.format("make_date(year, month, 1)")} AS season FROM b LEFT JOIN f USING (year, month)""", "year", "month", "energy_deficit_hours", "energy_surplus_hours", "year_month", "season"),
    "MA-13": twin(f"SELECT date, hour, matched_bids_mwh AS total_buy_mwh, matched_offers_mwh AS total_sell_mwh, ptf_try, matched_bids_mwh * ptf_try AS market_volume_try, matched_bids_mwh * ptf_try / nullif(matched_bids_mwh, 0) AS average_price_try FROM {_hours('dam_clearing', 'pricing')}", *_h),
    "MA-14": twin("""WITH r AS (SELECT *, min(active_volume) OVER w AS rolling_90d_min, max(active_volume) OVER w AS rolling_90d_max, avg(active_volume) OVER w AS rolling_90d_avg, avg(active_volume) OVER (PARTITION BY dam_id ORDER BY date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS rolling_7d_avg, lag(active_volume, 7) OVER (PARTITION BY dam_id ORDER BY date) AS active_volume_7d_ago
        FROM dams WINDOW w AS (PARTITION BY dam_id ORDER BY date ROWS BETWEEN 89 PRECEDING AND CURRENT ROW)),
        s AS (SELECT *, (active_volume - rolling_90d_min) / nullif(rolling_90d_max - rolling_90d_min, 0) AS hydro_stress_index, active_volume - active_volume_7d_ago AS wow_volume_change, (active_volume - active_volume_7d_ago) / nullif(active_volume_7d_ago, 0) AS wow_volume_change_pct FROM r)
        SELECT *, avg(hydro_stress_index) OVER (PARTITION BY date, basin_name) AS basin_avg_stress_index, sum(active_volume) OVER (PARTITION BY date, basin_name) AS basin_total_active_volume_mwh FROM s""", "date", "dam_id", "basin_name", "dam_name"),
    "MA-15": twin(f"""SELECT date, hour, net_imbalance_mwh, CASE sign(net_imbalance_mwh) WHEN -1 THEN 'Enerji Açığı (Negatif)' WHEN 1 THEN 'Enerji Fazlası (Pozitif)' ELSE 'Dengede' END AS imbalance_direction, ptf_try, smf_try, round({_deficit}, 4) AS deficit_settlement_price_try, round({_surplus}, 4) AS surplus_settlement_price_try,
        CASE sign(net_imbalance_mwh) WHEN -1 THEN round({_deficit}, 4) WHEN 1 THEN round({_surplus}, 4) ELSE ptf_try END AS settlement_price_try, CASE sign(net_imbalance_mwh) WHEN -1 THEN round(net_imbalance_mwh * {_deficit}, 2) WHEN 1 THEN round(net_imbalance_mwh * {_surplus}, 2) ELSE 0 END AS total_imbalance_cost_try FROM {_hours("(SELECT date, hour, net_imbalance_mwh FROM imbalance)", "pricing", "smf")}""", *_h, "imbalance_direction"),
    "MA-16": twin(f"SELECT date, hour, bid_offer_price_try, cumulative_supply_mwh, cumulative_demand_mwh, ptf_try, CASE WHEN bid_offer_price_try <= ptf_try THEN 'In Merit (Eşleşti)' ELSE 'Out of Merit (Eşleşmedi)' END AS supply_status FROM {_hours('supply_demand_curve', 'pricing')}", *_h, "supply_status"),
    "MA-17": twin(FEATURES, *_h, "day_of_week", "month", "year"),
    "MA-18": twin(ANALYSIS, *_h, "season", "price_block", "is_zero_price"),
    "MA-19": twin("""WITH r AS (SELECT date, hour, k.total_planned_mwh AS kgup_total_mwh, k.wind_mwh AS kgup_wind_mwh, k.solar_mwh AS kgup_solar_mwh, k.dam_hydro_mwh AS kgup_hydro_mwh, u.total_kgup_mwh AS kudup_total_mwh, u.wind_mwh AS kudup_wind_mwh, u.solar_mwh AS kudup_solar_mwh, u.dam_hydro_mwh AS kudup_hydro_mwh FROM sbfgp u FULL JOIN dpp k USING (date, hour))
        SELECT *, kudup_total_mwh - kgup_total_mwh AS intraday_revision_mwh, kudup_wind_mwh - kgup_wind_mwh AS wind_revision_mwh, kudup_solar_mwh - kgup_solar_mwh AS solar_revision_mwh, kudup_hydro_mwh - kgup_hydro_mwh AS hydro_revision_mwh,
        CASE WHEN kudup_total_mwh - kgup_total_mwh > 50 THEN 'GIP_Alim' WHEN kudup_total_mwh - kgup_total_mwh < -50 THEN 'GIP_Satis' ELSE 'Denge' END AS revision_direction, abs(kudup_total_mwh - kgup_total_mwh) / nullif(kgup_total_mwh, 0) * 100 AS revision_pct FROM r""", *_h, "revision_direction"),
    "MA-20": twin(f"SELECT date, hour, ptf_try, smf_try, forecasted_load_mwh, forecasted_res_mwh, forecasted_load_mwh - forecasted_res_mwh AS forecasted_residual_load_mwh, forecasted_res_mwh / nullif(forecasted_load_mwh, 0) * 100 AS renewable_penetration_pct FROM {_hours('pricing', 'smf', 'load_estimation', 'res_forecast')}", *_h),
    "MA-21": twin(EXTREMES, *_h, "system_direction", "ptf_category", "extreme_driver"),
    "MA-22": twin(REALIZED, *_h, "datetime", "price_status"),
    "MA-23": twin("SELECT date, hour, ptf_try, ptf_usd, ptf_eur, ptf_try / nullif(ptf_usd, 0) AS implicit_usdtry, avg(ptf_try) OVER (PARTITION BY date) AS ptf_try_daily_avg, avg(ptf_usd) OVER (PARTITION BY date) AS ptf_usd_daily_avg, strftime(date, '%Y-%m') AS year_month FROM pricing WHERE ptf_usd IS NOT NULL", *_h, "year_month"),
    "MA-24": twin(f"SELECT *, coalesce(up_net_mwh, 0) - coalesce(down_net_mwh, 0) AS net_system_position_mwh, coalesce(up_total_offered_mwh, 0) + coalesce(down_total_offered_mwh, 0) AS total_regulation_market_mwh, coalesce(up_total_offered_mwh, 0) / nullif(coalesce(down_total_offered_mwh, 0), 0) AS up_down_asymmetry_ratio FROM ({_side('order_up', 'up')}) FULL JOIN ({_side('order_down', 'down')}) USING (date, hour)", *_h),
    "MA-25": twin(f"""WITH l AS (SELECT date, hour, {_total(*[c for c in _green if not c.startswith("dam_")])} AS g FROM generation) SELECT date, hour, ptf_try, matched_bids_mwh AS total_demand_mwh, g AS licensed_renewable_mwh, coalesce(total_unlicensed_mwh, 0) AS total_unlicensed_mwh, g + coalesce(total_unlicensed_mwh, 0) AS total_green_energy_mwh, matched_bids_mwh - (g + coalesce(total_unlicensed_mwh, 0)) AS residual_load_mwh FROM {_hours("l", "unlicensed_generation", "dam_clearing", "pricing")}""", *_h),
    "MA-26": twin(f"SELECT date, hour, wind_generation_mwh, solar_generation_mwh, forecasted_res_mwh, wind_generation_mwh - forecasted_res_mwh AS wind_forecast_error FROM {_hours('generation', 'res_forecast')}", *_h),
    "MA-27": twin("""WITH h AS (SELECT *, actual_res_generation_mwh - forecasted_res_mwh AS forecast_error_mwh, abs(actual_res_generation_mwh - forecasted_res_mwh) AS abs_forecast_error_mwh, abs(actual_res_generation_mwh - forecasted_res_mwh) / nullif(forecasted_res_mwh, 0) * 100 AS forecast_error_pct FROM res_forecast),
        d AS (SELECT date, max(forecasted_res_mwh) - min(forecasted_res_mwh) AS intraday_forecast_range_mwh, max(actual_res_generation_mwh) - min(actual_res_generation_mwh) AS intraday_actual_range_mwh, avg(abs_forecast_error_mwh) AS daily_mae_mwh, avg(forecast_error_pct) AS daily_mape_pct, avg(forecast_error_mwh) AS daily_bias_mwh, first(hour ORDER BY actual_res_generation_mwh DESC NULLS LAST, hour) FILTER (actual_res_generation_mwh IS NOT NULL) AS peak_res_hour, max(actual_res_generation_mwh) AS peak_res_mwh FROM h GROUP BY 1),
        r AS (SELECT *, avg(daily_mae_mwh) OVER (ORDER BY date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS rolling_7d_mae_mwh FROM d) SELECT * FROM h JOIN r USING (date)""", *_h, "peak_res_hour"),
    "MA-28": twin(SHIFTS, "date", "cheapest_8h_start_hour", "priciest_8h_start_hour"),
    "MA-29": twin(f"SELECT date, hour, {_at} AS datetime, smf_try AS value, 'realized' AS value_source FROM smf UNION ALL SELECT p.date + 1, p.hour, {_at.replace('date::', '(p.date + 1)::').replace('hour *', 'p.hour *')}, p.smf_try + (p.hour % 5 - 2), 'model' FROM smf p ANTI JOIN smf r ON r.date = p.date + 1 AND r.hour = p.hour", *_h, "datetime", "value_source"),
    "MA-30": twin(f"""WITH rh AS (SELECT hour, avg(forecasted_res_mwh) AS ur FROM res_forecast WHERE date >= DATE '{AS_OF}' - 14 GROUP BY 1), ah AS (SELECT hour, avg(total_aic_mwh) AS ua FROM aic WHERE date >= DATE '{AS_OF}' - 14 GROUP BY 1), shock AS ({SHOCK}),
        sh AS (SELECT *, avg(supply_shock_index) OVER (ORDER BY date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS tr FROM shock), cl AS (SELECT date + 1 AS date, hour, arbitrage_opportunity_score, yal_delivered_mwh, yat_delivered_mwh, net_dgp_mwh FROM ({SPREAD})),
        ranked AS (SELECT *, row_number() OVER (ORDER BY date DESC, hour DESC) AS n FROM smf), ls AS (SELECT max({_at}) FILTER (n = 1) AS frozen, max(smf_try) FILTER (n = 1) AS now, avg(smf_try) FILTER (n <= 24) AS avg24, max(smf_try) FILTER (n <= 24) AS max24, min(smf_try) FILTER (n <= 24) AS min24, avg(smf_try) FILTER (n <= 168) AS avg168 FROM ranked),
        ld AS (SELECT system_direction AS system_direction_lag_5h FROM system_direction ORDER BY date DESC, hour DESC LIMIT 1), l24 AS (SELECT date + 1 AS date, hour, smf_try AS s24 FROM smf), l168 AS (SELECT date + 7 AS date, hour, smf_try AS s168 FROM smf), cap AS (SELECT date, hour, total_aic_mwh FROM aic), rf AS (SELECT date, hour, forecasted_res_mwh AS fr FROM res_forecast), pt AS (SELECT date, hour, ptf_try FROM ({REALIZED})),
        j AS (SELECT *, {_at} AS datetime, greatest(0, date_diff('hour', frozen, {_at})) AS lead_hours, coalesce(fr, ur, 0) AS green FROM {_hours("load_estimation", "rf", "cap", "cl", "pt", "l24", "l168")} LEFT JOIN rh USING (hour) LEFT JOIN ah USING (hour) LEFT JOIN sh USING (date), ls, ld)
        SELECT date, hour, datetime, lead_hours, forecasted_load_mwh, green AS forecasted_res_mwh, forecasted_load_mwh - green AS forecasted_residual_load_mwh, (forecasted_load_mwh - green) / nullif(coalesce(total_aic_mwh, ua), 0) AS capacity_utilization_ratio, coalesce(supply_shock_index, 0) AS supply_shock_index, coalesce(total_outage_mwh, 0) AS total_outage_mwh, coalesce(tr, 0) AS supply_shock_trend_7d,
          coalesce(arbitrage_opportunity_score, 0) AS arb_score_lag24, coalesce(yal_delivered_mwh, 0) AS yal_lag24, coalesce(yat_delivered_mwh, 0) AS yat_lag24, coalesce(net_dgp_mwh, 0) AS net_dgp_lag24, ptf_try, s24 AS smf_try_lag_24h, s168 AS smf_try_lag_168h, system_direction_lag_5h, {_fade("now")} AS smf_try_lag_5h, {_fade("avg24")} AS smf_rolling_avg_24h, {_fade("max24")} AS smf_rolling_max_24h, {_fade("min24")} AS smf_rolling_min_24h, avg168 AS smf_rolling_avg_168h FROM j""", *_h, "datetime", "lead_hours", "system_direction_lag_5h"),
    "MA-31": twin(f"""SELECT f.*, {_at} AS datetime, system_direction, lag(smf_try, 5) OVER o AS smf_try_lag_5h, lag(smf_try, 24) OVER o AS smf_try_lag_24h, lag(smf_try, 168) OVER o AS smf_try_lag_168h, avg(smf_try) OVER d AS smf_rolling_avg_24h, max(smf_try) OVER d AS smf_rolling_max_24h, min(smf_try) OVER d AS smf_rolling_min_24h, avg(smf_try) OVER w AS smf_rolling_avg_168h, lag(system_direction, 5) OVER o AS system_direction_lag_5h
        FROM ({FEATURES}) f LEFT JOIN system_direction USING (date, hour) WINDOW o AS (ORDER BY date, hour), d AS (ORDER BY date, hour ROWS BETWEEN 24 PRECEDING AND 1 PRECEDING), w AS (ORDER BY date, hour ROWS BETWEEN 168 PRECEDING AND 1 PRECEDING)""", *_h, "day_of_week", "month", "year", "datetime", "system_direction", "system_direction_lag_5h"),
    "MA-32": twin(f"SELECT date, hour, {_at} AS datetime, smf_try FROM smf", *_h, "datetime"),
    "MA-33": twin("SELECT *, cumulative_supply_mwh - cumulative_demand_mwh AS net_supply_mwh FROM supply_demand_curve", *_h),
    "MA-34": twin(SHOCK, "date"),
    "MA-35": twin(f"WITH u AS (SELECT date, hour, up_regulation_delivered_mwh AS a FROM order_up), d AS (SELECT date, hour, down_regulation_delivered_mwh AS b FROM order_down), imb AS (SELECT date, hour, net_imbalance_mwh FROM imbalance) SELECT date, hour, system_direction, net_imbalance_mwh, smf_try, ptf_try, smf_try - ptf_try AS smf_ptf_spread_try, coalesce(a, 0) AS total_yal_mwh, coalesce(b, 0) AS total_yat_mwh FROM {_hours('smf', 'pricing', 'system_direction', 'imb', 'u', 'd')}", *_h, "system_direction"),
    "MA-36": twin("SELECT date, total_unlicensed_mwh, ptf_try, total_unlicensed_mwh * ptf_try AS estimated_market_value_try FROM (SELECT date, sum(total_unlicensed_mwh) AS total_unlicensed_mwh FROM unlicensed_generation GROUP BY 1) LEFT JOIN (SELECT date, avg(ptf_try) AS ptf_try FROM pricing GROUP BY 1) USING (date)", "date"),
    "MA-37": twin(TRADE_WEATHER, "date", "total_transaction_count"),
}

#: Staged tables with the columns that aren't rounded.
STAGED_KEYS: dict[str, tuple[str, ...]] = {
    **{n: _h for n in ("pricing", "interim_mcp", "smf", "generation", "unlicensed_generation", "load_estimation", "load_vs_actual", "res_forecast", "aic", "dpp", "sbfgp", "dam_clearing", "order_up", "order_down", "imbalance", "price_ind_bid", "supply_demand_curve")},
    "kgup_bulk_by_org": (*_h, "org_id", "uevcb_id", "uevcb_name"), "dam_clearing_by_org": (*_h, "organization_id", "organization_name"), "idm_transactions": (*_h, "id", "contract_name"),
    "outages": ("date", "id", "start_time", "end_time", "company_name", "plant_name", "outage_reason"), "dams": ("date", "dam_id", "basin_name", "dam_name"), "weather": (*_h, "city_name"), "fx_rates": ("date", "is_ffilled"),
}
STAGED_TWINS = {n: twin(f"SELECT * FROM {n}", *keys) for n, keys in STAGED_KEYS.items()} | {n: twin(f"SELECT * FROM {n}", rounded=False) for n in ("system_direction", "participants")}
STAGED_TWINS["price_spread"] = twin("SELECT date, hour, ptf_try, smf_try, ptf_try - smf_try AS price_spread_try FROM pricing LEFT JOIN smf USING (date, hour)", *_h)
STAGED_TWINS["outages_daily"] = twin(f"SELECT id, company_name, plant_name, installed_capacity_mwh, outage_capacity_mwh, outage_reason, date AS start_date, end_time::DATE AS end_date, unnest(generate_series(date, least(end_time::DATE, DATE '{AS_OF}'), INTERVAL 1 DAY))::DATE AS active_date FROM outages WHERE end_time::DATE >= date", "id", "company_name", "plant_name", "outage_reason", "start_date", "end_date", "active_date")
STAGED_TWINS["idm_transactions_recent"] = twin(f"SELECT * FROM idm_transactions WHERE date >= DATE '{AS_OF}' - 7", *_h, "id", "contract_name")
