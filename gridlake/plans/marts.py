"""Market marts as DataFrame plans over staged tables.

Each mart takes a :class:`~gridlake.plans.staging.Lake` and, where "today" matters, ``as_of``. Tables of one row per day
are broadcast into hourly ones, as days are few (a century is 36,525 rows); joins on (date, hour) share their keys.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.expressions import (
    DEFICIT,
    SURPLUS,
    deficit_price,
    instant_of,
    price_block,
    ratio,
    season,
    surplus_price,
    total,
    weighted_price,
    zero,
)
from ..operators import sketches
from ..operators.keyed import HOUR, on_hour
from ..sources.shared import written
from .hourly import BUCKETS, at_once, bucketed, market_hours, trade_hours
from .staging import Lake

C = F.col
#: Fuels for which capacity and generation are both published, with the name of the ratio.
UTILISED = {"total": "total", "gas": "gas", "wind": "wind", "solar": "solar", "lignite": "lignite", "imported_coal": "imported_coal", "geothermal": "geothermal", "dam": "dam_hydro", "river": "run_of_river", "biomass": "biomass"}
UNMATCHED = ["lng_generation_mwh", "asphaltite_coal_generation_mwh", "black_coal_generation_mwh", "waste_heat_generation_mwh", "import_export_mwh"]
GREEN = [f"{f}_generation_mwh" for f in ("wind", "solar", "dam", "river", "geothermal", "biomass")]
FOSSIL = [f"{f}_generation_mwh" for f in ("gas", "lignite", "imported_coal", "black_coal", "asphaltite_coal", "fueloil", "naphtha", "lng")]


def by_day():
    return Window.partitionBy("date")


def day_side(df: DataFrame) -> DataFrame:
    """A table of one row per day, small by its grain."""
    return F.broadcast(df)


def prices(lake: Lake) -> DataFrame:
    return lake["pricing"].select(*HOUR, "ptf_try")


def capacity_utilization(lake: Lake) -> DataFrame:
    both = lake["aic"].join(lake["generation"], HOUR, "full")
    columns = [*HOUR]
    for fuel, name in UTILISED.items():
        have, made = f"{fuel}_aic_mwh", f"{fuel}_generation_mwh"
        columns += [have, made, ratio(made, have).alias(f"{name}_utilization_ratio")]
    return both.select(*columns, *UNMATCHED)


def company_gop_activity(lake: Lake) -> DataFrame:
    bids, offers = F.sum("matched_bids_mwh"), F.sum("matched_offers_mwh")
    return lake["dam_clearing_by_org"].groupBy(C("date").alias("trade_date"), "organization_id", "organization_name").agg(
        bids.alias("total_bids_mwh"), offers.alias("total_offers_mwh"), (bids - offers).alias("net_position_mwh"), (bids + offers).alias("total_volume_mwh"),
        F.count_if((C("matched_bids_mwh") > 0) | (C("matched_offers_mwh") > 0)).alias("active_hours"),
    )


def company_production_activity(lake: Lake) -> DataFrame:
    sums = {"total_kgup_mwh": "total_kgup_mwh", "natural_gas_mwh": "natural_gas_mwh", "wind_mwh": "wind_mwh", "hydro_mwh": "dam_hydro_mwh + river_hydro_mwh", "solar_mwh": "solar_mwh", "coal_mwh": "lignite_mwh + hard_coal_mwh + imported_coal_mwh"}
    per = lake["kgup_bulk_by_org"].groupBy(C("date").alias("trade_date"), "org_id").agg(F.count_distinct("uevcb_id").alias("active_uevcb_count"), *[F.sum(F.expr(e)).alias(n) for n, e in sums.items()])
    names = lake["participants"].select(C("organization_id").alias("org_id"), "organization_name")
    return per.join(names, "org_id", "left").select("trade_date", "org_id", "organization_name", "active_uevcb_count", *sums)


#: Staged hourly tables that the spread reads.
SPREAD_TABLES = ["pricing", "smf", "system_direction", "imbalance", "order_up", "order_down"]


def spread_of(hours: DataFrame, trades: DataFrame) -> DataFrame:
    """The spread from tables side by side (see ``hourly.market_hours``) and hourly trades; both lie by (date, hour)."""
    wide = hours.where("pricing IS NOT NULL").join(trades, HOUR, "left")
    ahead, intraday, balancing, direction = C("pricing.ptf_try"), C("gip_vwap_try"), C("smf.smf_try"), C("system_direction.system_direction")
    # Down regulation counts in hours that have up regulation, an imbalance in hours that have a direction.
    has_up, has_direction = C("order_up").isNotNull(), C("system_direction").isNotNull()
    yal, yat = F.when(has_up, zero("order_up.up_regulation_delivered_mwh")), F.when(has_up, C("order_down.down_regulation_delivered_mwh"))
    net_imbalance = F.when(has_direction, C("imbalance.net_imbalance_mwh"))
    step, next_step = F.signum(intraday - ahead), F.signum(balancing - intraday)
    cascade = F.when((step > 0) & (next_step > 0), "ESCALATING").when((step < 0) & (next_step < 0), "DESCENDING").when((step > 0) & (next_step < 0), "GIP_PEAK").when((step < 0) & (next_step > 0), "GIP_TROUGH").otherwise("FLAT")
    paid = ((direction == DEFICIT) & (step > 0)) | ((direction == SURPLUS) & (step < 0))
    gap = F.abs(intraday - ahead)
    return wide.select(
        *HOUR, ahead.alias("gop_ptf_try"), "gip_vwap_try", "gip_avg_price_try", balancing.alias("dgp_smf_try"),
        (intraday - ahead).alias("gip_gop_spread_try"), (balancing - ahead).alias("smf_gop_spread_try"), (balancing - intraday).alias("smf_gip_spread_try"),
        gap.alias("gip_gop_spread_abs"), (ratio(gap, ahead) * 100).alias("gip_gop_spread_pct"), cascade.alias("price_cascade"),
        F.when(paid, ratio(gap, ahead)).otherwise(0.0).alias("arbitrage_opportunity_score"), direction.alias("system_direction"), zero(net_imbalance).alias("net_imbalance_mwh"),
        zero(yal).alias("yal_delivered_mwh"), zero(yat).alias("yat_delivered_mwh"), F.when(yal.isNull(), 0.0).otherwise(yal - zero(yat)).alias("net_dgp_mwh"),
        zero("gip_total_volume_mwh").alias("gip_total_volume_mwh"), F.coalesce("gip_transaction_count", F.lit(0)).alias("gip_transaction_count"), "gip_min_price_try", "gip_max_price_try", "gip_price_range_try",
    )


def cross_market_spread(lake: Lake) -> DataFrame:
    """Day-ahead, intraday and balancing prices side by side."""
    return spread_of(market_hours(lake, *SPREAD_TABLES), trade_hours(lake))


#: What the spread of the day before gives to feature tables, by its column there.
YESTERDAY = {"gip_gop_spread_try": "gip_gop_spread_lag24", "arbitrage_opportunity_score": "arb_score_lag24", "yal_delivered_mwh": "yal_lag24", "yat_delivered_mwh": "yat_lag24", "net_dgp_mwh": "net_dgp_lag24"}


def dgp_system_analysis(lake: Lake) -> DataFrame:
    """Up and down regulation of an hour; an hour that one side lacks counts as zero there."""
    def side(name: str, direction: str, short: str) -> DataFrame:
        parts = {"delivered": "delivered", "zero": "zero_price", "one": "one_coded", "two": "two_coded"}
        return lake[name].select(*HOUR, *[C(f"{direction}_regulation_{a}_mwh").alias(f"{short}_{b}_mwh") for a, b in parts.items()], C("net_mwh").alias(f"{short}_net_mwh"))

    both = side("order_up", "up", "yal").join(side("order_down", "down", "yat"), HOUR, "full")
    flat = both.select(*HOUR, *[zero(c).alias(c) for c in both.columns if c not in HOUR])
    return flat.withColumns({
        "net_dgp_mwh": C("yal_delivered_mwh") - C("yat_delivered_mwh"), "zero_price_ratio_yal": ratio("yal_zero_price_mwh", "yal_delivered_mwh"),
        "zero_price_ratio_yat": ratio("yat_zero_price_mwh", "yat_delivered_mwh"), "total_regulation_mwh": C("yal_delivered_mwh") + C("yat_delivered_mwh"),
    })


def forecast_error(lake: Lake) -> DataFrame:
    made = lake["generation"].select(*HOUR, zero("wind_generation_mwh").alias("wind_mwh"), zero("solar_generation_mwh").alias("solar_mwh")).withColumn("actual_res_mwh", C("wind_mwh") + C("solar_mwh"))
    told = lake["res_forecast"].select(*HOUR, "forecasted_res_mwh", C("actual_res_generation_mwh").alias("published_actual_res_mwh"))
    error = C("forecasted_res_mwh") - C("actual_res_mwh")
    each = told.join(made, HOUR, "full").withColumns({
        "forecast_error_mwh": error, "abs_error_mwh": F.abs(error), "error_pct": ratio(F.abs(error), "actual_res_mwh") * 100,
        "error_direction": F.when(error > 0, "Aşırı Tahmin").when(error < 0, "Eksik Tahmin").otherwise("Eşleşme"),
    })
    return each.withColumns({"daily_rmse_mwh": F.round(F.sqrt(F.avg(C("forecast_error_mwh") * C("forecast_error_mwh")).over(by_day())), 2), "daily_mape_pct": F.round(F.avg("error_pct").over(by_day()), 2)})


def forecasted_residual_load(lake: Lake) -> DataFrame:
    """Averages per hour first, so that no side multiplies another's rows."""
    mean = lambda name, c: lake[name].groupBy(*HOUR).agg(F.avg(c).alias(c))
    wide = on_hour(mean("load_estimation", "forecasted_load_mwh"), mean("res_forecast", "forecasted_res_mwh"), mean("pricing", "ptf_try"), mean("price_ind_bid", "price_independent_bid_mwh"))
    return wide.withColumns({"datetime": instant_of(), "forecasted_residual_load_mwh": C("forecasted_load_mwh") - C("forecasted_res_mwh")})


def generation_mix(lake: Lake) -> DataFrame:
    all_of = C("total_generation_mwh")
    return lake["generation"].select(*HOUR, all_of.alias("total_generation"), ratio(total(*GREEN), all_of).alias("renewable_ratio"), ratio(total(*FOSSIL), all_of).alias("fossil_ratio"))


def gip_company_activity(lake: Lake) -> DataFrame:
    return lake["idm_transactions"].groupBy(C("date").alias("trade_date"), "hour", "contract_name").agg(
        F.count("id").alias("total_transaction_count"), F.avg("price_try").alias("avg_transaction_price_try"), F.sum("quantity_mwh").alias("total_volume_mwh"), F.sum(C("price_try") * C("quantity_mwh")).alias("total_transaction_value_try")
    )


def gip_hourly_reference(lake: Lake) -> DataFrame:
    return lake["idm_transactions"].groupBy(*HOUR).agg(weighted_price().alias("gip_vwap_try"), F.sum("quantity_mwh").alias("gip_volume_mwh"), F.count("*").alias("gip_transaction_count"))


def gold_monthly_executive_metrics(lake: Lake) -> DataFrame:
    month = [F.year("date").alias("year"), F.month("date").alias("month")]
    mean = lambda c, n: F.round(F.avg(c), 2).alias(n)
    base = on_hour(price_analysis(lake), lake["system_direction"]).groupBy(*month).agg(
        mean("ptf_try", "avg_ptf"), F.round(F.max("ptf_try"), 2).alias("max_ptf"), F.round(F.min("ptf_try"), 2).alias("min_ptf"), mean("price_spread", "avg_price_spread"),
        F.count_if(C("system_direction") == DEFICIT).alias("energy_deficit_hours"), F.count_if(C("system_direction") == SURPLUS).alias("energy_surplus_hours"),
    )
    load = forecasted_residual_load(lake).groupBy(*month).agg(mean("forecasted_load_mwh", "avg_forecast_consumption"))
    first = F.make_date("year", "month", F.lit(1))
    return base.join(load, ["year", "month"], "left").withColumns({"year_month": F.date_format(first, "yyyy-MM"), "season": season(first)}).orderBy(C("year").desc(), C("month").desc())


def gop_volume_analysis(lake: Lake) -> DataFrame:
    bought = C("matched_bids_mwh")
    return on_hour(lake["dam_clearing"], prices(lake)).select(*HOUR, bought.alias("total_buy_mwh"), C("matched_offers_mwh").alias("total_sell_mwh"), "ptf_try", (bought * C("ptf_try")).alias("market_volume_try"), ratio(bought * C("ptf_try"), bought).alias("average_price_try"))


def hydro_risk(lake: Lake) -> DataFrame:
    """Where a reservoir's level lies in its last 90 rows, and its basin's mean."""
    dam = Window.partitionBy("dam_id").orderBy("date")
    level, quarter = C("active_volume"), dam.rowsBetween(-89, 0)
    low, high = F.min(level).over(quarter), F.max(level).over(quarter)
    basin = Window.partitionBy("date", "basin_name")
    own = lake["dams"].select(
        "date", "dam_id", "basin_name", "dam_name", "active_volume", low.alias("rolling_90d_min"), high.alias("rolling_90d_max"), F.avg(level).over(quarter).alias("rolling_90d_avg"),
        F.avg(level).over(dam.rowsBetween(-6, 0)).alias("rolling_7d_avg"), F.lag(level, 7).over(dam).alias("active_volume_7d_ago"),
    ).withColumns({
        "hydro_stress_index": ratio(level - C("rolling_90d_min"), C("rolling_90d_max") - C("rolling_90d_min")),
        "wow_volume_change": level - C("active_volume_7d_ago"), "wow_volume_change_pct": ratio(level - C("active_volume_7d_ago"), "active_volume_7d_ago"),
    })
    return own.withColumns({"basin_avg_stress_index": F.avg("hydro_stress_index").over(basin), "basin_total_active_volume_mwh": F.sum("active_volume").over(basin)})


def imbalance_cost(lake: Lake) -> DataFrame:
    """Settlement of the imbalance: the dearer price plus 3 % for a shortage, the cheaper less 3 % for a surplus."""
    net, ptf, smf = C("net_imbalance_mwh"), C("ptf_try"), C("smf_try")
    short, long = deficit_price(ptf, smf), surplus_price(ptf, smf)
    by_sign = lambda a, b, c: F.when(net < 0, a).when(net > 0, b).otherwise(c)
    return on_hour(lake["imbalance"].select(*HOUR, "net_imbalance_mwh"), prices(lake), lake["smf"]).select(
        *HOUR, net, by_sign(F.lit("Enerji Açığı (Negatif)"), F.lit("Enerji Fazlası (Pozitif)"), F.lit("Dengede")).alias("imbalance_direction"), ptf, smf,
        F.round(short, 4).alias("deficit_settlement_price_try"), F.round(long, 4).alias("surplus_settlement_price_try"),
        by_sign(F.round(short, 4), F.round(long, 4), ptf).alias("settlement_price_try"), by_sign(F.round(net * short, 2), F.round(net * long, 2), F.lit(0.0)).alias("total_imbalance_cost_try"),
    )


def merit_order(lake: Lake) -> DataFrame:
    inside = C("bid_offer_price_try") <= C("ptf_try")
    return on_hour(lake["supply_demand_curve"], prices(lake)).withColumn("supply_status", F.when(inside, "In Merit (Eşleşti)").otherwise("Out of Merit (Eşleşmedi)"))


def outage_spans(lake: Lake) -> DataFrame:
    """Capacity and number of outages by first and last day, written once a lake: plans below read it several times."""
    if not hasattr(lake, "_outage_spans"):
        days = [F.to_date("start_time").alias("first"), F.to_date("end_time").alias("until")]
        lake._outage_spans = written(lake["outages"].where("end_time > start_time").groupBy(*days).agg(F.sum("outage_capacity_mwh").alias("mw"), F.count("*").alias("n")))
    return lake._outage_spans


def outage_days(lake: Lake, as_of) -> DataFrame:
    """Capacity lost on each day: a span adds at its start and takes off after its end, and a running sum over days adds up.

    Two rows per pair of days and one per day of the calendar, however long spans are.
    """
    last = F.least("until", F.lit(as_of).cast("date"))
    spans = outage_spans(lake).select("first", last.alias("last"), "mw", "n").where("last >= first")
    edges = spans.select(F.explode(F.array(F.struct(C("first").alias("date"), "mw", "n"), F.struct(F.date_add("last", 1).alias("date"), (-C("mw")).alias("mw"), (-C("n")).alias("n")))).alias("e"))
    daily = edges.groupBy("e.date").agg(F.sum("e.mw").alias("mw"), F.sum("e.n").alias("n"))
    calendar = daily.agg(F.min("date").alias("a"), F.max("date").alias("b")).where("a IS NOT NULL").select(F.explode(F.sequence("a", "b")).alias("date"))
    running = Window.orderBy("date").rowsBetween(Window.unboundedPreceding, 0)
    summed = calendar.join(daily, "date", "left").select("date", F.sum(zero("mw")).over(running).alias("total_outage_mwh"), F.sum(F.coalesce("n", F.lit(0))).over(running).alias("open"))
    return summed.where("open > 0").drop("open")


def supply_shock_index(lake: Lake, as_of) -> DataFrame:
    capacity = lake["aic"].groupBy("date").agg(F.sum("total_aic_mwh").alias("total_available_capacity_mwh"))
    return outage_days(lake, as_of).join(capacity, "date", "left").withColumn("supply_shock_index", ratio("total_outage_mwh", "total_available_capacity_mwh"))


def feature_hours(lake: Lake, as_of, outages_by: str = "active") -> DataFrame:
    """The feature table with the system direction: hourly tables on their hour, daily tables on their day, yesterday's spreads on the same hour.

    What is read twice (hours, trades) and what has a day's or an hour's grain (weather, outages, rates) is written first,
    side by side; the plan that is left joins aligned files.
    """
    def weather() -> DataFrame:
        means = [F.avg(c).alias(c) for c in ("temperature_celsius", "wind_speed_kmh", "shortwave_radiation", "relative_humidity")]
        return bucketed(lake["weather"].repartition(BUCKETS, *HOUR).groupBy(*HOUR).agg(*means))

    def days() -> DataFrame:
        lost = outage_days(lake, as_of) if outages_by == "active" else lake["outages"].groupBy("date").agg(F.sum("outage_capacity_mwh").alias("total_outage_mwh"))
        return written(lost.join(fx_features(lake), "date", "full"))

    tables = [*SPREAD_TABLES, "load_estimation", "res_forecast", "dam_clearing", "aic", "generation", "load_vs_actual"]
    hours, trades, weathers, daily = at_once(lambda: bucketed(market_hours(lake, *tables)), lambda: bucketed(trade_hours(lake)), weather, days)
    yesterday = spread_of(hours, trades).select(F.date_add("date", 1).alias("date"), "hour", *[C(c).alias(n) for c, n in YESTERDAY.items()])
    traded = trades.groupBy("date").agg(ratio(F.sum("contract_means"), F.sum("contracts")).alias("avg_gip_price_try"), F.sum("gip_total_volume_mwh").alias("total_gip_volume_mwh"))
    wide = hours.where("pricing IS NOT NULL").join(weathers, HOUR, "left").join(yesterday, HOUR, "left")
    wide = wide.join(day_side(daily), "date", "left").join(day_side(traded), "date", "left")
    made = {f: zero(f"generation.{f}_generation_mwh") for f in ("wind", "solar", "gas")}
    hydro, every = total("generation.dam_generation_mwh", "generation.river_generation_mwh"), C("generation.total_generation_mwh")
    green = made["wind"] + made["solar"] + hydro
    there = C("generation").isNotNull()
    bought, sold = C("dam_clearing.matched_bids_mwh"), C("dam_clearing.matched_offers_mwh")
    load, told, ptf, smf, capacity = C("load_estimation.forecasted_load_mwh"), C("res_forecast.forecasted_res_mwh"), C("pricing.ptf_try"), C("smf.smf_try"), C("aic.total_aic_mwh")
    used = C("load_vs_actual.actual_consumption")
    filled = {
        "gop_matched_bids_mwh": bought, "gop_matched_offers_mwh": sold, "gop_volume_imbalance_mwh": bought - sold, "total_outage_mwh": C("total_outage_mwh"), "actual_renewable_mwh": F.when(there, green), "actual_renewable_ratio": ratio(green, every),
        "wind_generation_mwh": made["wind"], "solar_generation_mwh": made["solar"], "hydro_generation_mwh": hydro, "gas_generation_mwh": made["gas"], "total_generation_mwh": every, "net_imbalance_mwh": C("imbalance.net_imbalance_mwh"),
        **{c: C(c) for c in ("yal_lag24", "yat_lag24", "net_dgp_lag24", "usdtry")},
    }
    return wide.select(
        *HOUR, ptf, smf, (smf - ptf).alias("ptf_smf_spread"), load, told, (load - told).alias("forecasted_residual_load_mwh"),
        zero(capacity).alias("total_aic_mwh"), ratio(load - told, capacity).alias("capacity_utilization_ratio"), *[zero(c).alias(n) for n, c in filled.items()], "avg_gip_price_try", "total_gip_volume_mwh",
        (C("avg_gip_price_try") - ptf).alias("gip_gop_price_spread"), "gip_gop_spread_lag24", "arb_score_lag24", used.alias("actual_consumption_mwh"), (used - load).alias("consumption_error_mwh"),
        "temperature_celsius", "wind_speed_kmh", "shortwave_radiation", "relative_humidity", F.dayofweek("date").alias("day_of_week"), F.month("date").alias("month"), F.year("date").alias("year"),
        "usdtry_lag_1d", "usdtry_lag_7d", "usdtry_pct_change_1d", C("system_direction.system_direction"),
    )


def ml_features(lake: Lake, as_of, outages_by: str = "active") -> DataFrame:
    """The feature table. Outages count on every day that they are active, or on their first day with ``outages_by="start"``."""
    return feature_hours(lake, as_of, outages_by).drop("system_direction")


def fx_features(lake: Lake) -> DataFrame:
    """Exchange rate and its value 1 and 7 quotes ago (rows, so a weekend is one step)."""
    quotes = Window.orderBy("date")
    lagged = lake["fx_rates"].select("date", "usdtry", F.lag("usdtry", 1).over(quotes).alias("usdtry_lag_1d"), F.lag("usdtry", 7).over(quotes).alias("usdtry_lag_7d"))
    return lagged.withColumn("usdtry_pct_change_1d", ratio(C("usdtry") - C("usdtry_lag_1d"), "usdtry_lag_1d"))


def price_analysis(lake: Lake) -> DataFrame:
    ptf, smf = C("ptf_try"), C("smf_try")
    return on_hour(prices(lake), lake["smf"]).select(
        *HOUR, ptf, smf, (ptf - F.coalesce(smf, ptf)).alias("price_spread"), season("date").alias("season"), price_block("hour").alias("price_block"),
        F.round(deficit_price(ptf, smf), 4).alias("deficit_settlement_price"), F.round(surplus_price(ptf, smf), 4).alias("surplus_settlement_price"),
        F.round(ptf / 4500.0 * 100.0, 2).alias("cap_proximity_pct"), (ptf == 0).alias("is_zero_price"), F.round(F.max(ptf).over(by_day()) - F.min(ptf).over(by_day()), 4).alias("daily_ptf_range"),
    )


def production_plan(lake: Lake) -> DataFrame:
    """Day-ahead plan against settled plan."""
    parts = {"total": ("total_planned_mwh", "total_kgup_mwh"), "wind": ("wind_mwh", "wind_mwh"), "solar": ("solar_mwh", "solar_mwh"), "hydro": ("dam_hydro_mwh", "dam_hydro_mwh")}
    plan = lake["dpp"].select(*HOUR, *[C(a).alias(f"kgup_{n}_mwh") for n, (a, _) in parts.items()])
    settled = lake["sbfgp"].select(*HOUR, *[C(b).alias(f"kudup_{n}_mwh") for n, (_, b) in parts.items()])
    revised = {("intraday" if n == "total" else n) + "_revision_mwh": C(f"kudup_{n}_mwh") - C(f"kgup_{n}_mwh") for n in parts}
    change = C("intraday_revision_mwh")
    return settled.join(plan, HOUR, "full").withColumns(revised).withColumns({"revision_direction": F.when(change > 50, "GIP_Alim").when(change < -50, "GIP_Satis").otherwise("Denge"), "revision_pct": ratio(F.abs(change), "kgup_total_mwh") * 100})


def ptf_drivers(lake: Lake) -> DataFrame:
    load, green = C("forecasted_load_mwh"), C("forecasted_res_mwh")
    return on_hour(prices(lake), lake["smf"], lake["load_estimation"], lake["res_forecast"].select(*HOUR, "forecasted_res_mwh")).withColumns({"forecasted_residual_load_mwh": load - green, "renewable_penetration_pct": ratio(green, load) * 100})


def ptf_extremes(lake: Lake, daily: DataFrame | None = None) -> DataFrame:
    """Hours at or beyond the 5th and 95th percentile of the price, with a likely cause.

    Percentiles come from daily sketches, those that are kept (``operators.sketches.kept``) or new ones.
    """
    whole = sketches.merged(daily if daily is not None else sketches.made(prices(lake), "ptf_try", ["date"]), [])
    stats = whole.select(sketches.quantiles([0.05, 0.95]).alias("p"), ratio("total", "n").alias("avg_ptf")).select(C("p")[0].alias("p5_ptf"), C("p")[1].alias("p95_ptf"), "avg_ptf")
    hours = on_hour(ptf_drivers(lake).drop("renewable_penetration_pct").withColumnRenamed("forecasted_residual_load_mwh", "residual_load_mwh"), lake["aic"].select(*HOUR, "total_aic_mwh"), lake["system_direction"], lake["imbalance"].select(*HOUR, "net_imbalance_mwh"))
    hours = hours.withColumns({"smf_ptf_spread": C("smf_try") - C("ptf_try"), "capacity_utilization_ratio": ratio("residual_load_mwh", "total_aic_mwh")}).crossJoin(F.broadcast(stats))
    dear, cheap = C("ptf_try") >= C("p95_ptf"), C("ptf_try") <= C("p5_ptf")
    cause = F.when(dear, F.when(C("capacity_utilization_ratio") > 0.9, "Kapasite_Stresi").when(C("system_direction") == DEFICIT, "Sistem_Acigi").otherwise("Diger_Tavan")).when(cheap, F.when(C("residual_load_mwh") < 0, "RES_Fazlasi").when(C("system_direction") == SURPLUS, "Uretim_Fazlasi").otherwise("Diger_Minimum"))
    return hours.withColumns({"ptf_category": F.when(dear, "TAVAN").when(cheap, "MINIMUM").otherwise("NORMAL"), "extreme_driver": cause})


def ptf_realized(lake: Lake) -> DataFrame:
    """The final price, else the interim one."""
    both = prices(lake).withColumnRenamed("ptf_try", "final").join(lake["interim_mcp"], HOUR, "full")
    return both.select(*HOUR, instant_of().alias("datetime"), F.coalesce("final", "interim_ptf_try").alias("ptf_try"), F.when(C("final").isNotNull(), "final").otherwise("interim").alias("price_status"))


def ptf_usd(lake: Lake) -> DataFrame:
    return lake["pricing"].where("ptf_usd IS NOT NULL").withColumns({"implicit_usdtry": ratio("ptf_try", "ptf_usd"), "ptf_try_daily_avg": F.avg("ptf_try").over(by_day()), "ptf_usd_daily_avg": F.avg("ptf_usd").over(by_day()), "year_month": F.date_format("date", "yyyy-MM")})


def regulation_depth(lake: Lake) -> DataFrame:
    def side(name: str, s: str) -> DataFrame:
        steps = [f"{s}_regulation_{b}_mwh" for b in ("zero", "one", "two")]
        return lake[name].select(*HOUR, *steps, f"{s}_regulation_delivered_mwh", total(*steps).alias(f"{s}_total_offered_mwh"), C("net_mwh").alias(f"{s}_net_mwh")).withColumn(f"{s}_activation_rate", ratio(f"{s}_regulation_delivered_mwh", f"{s}_total_offered_mwh"))

    both = side("order_up", "up").join(side("order_down", "down"), HOUR, "full")
    return both.withColumns({
        "net_system_position_mwh": zero("up_net_mwh") - zero("down_net_mwh"), "total_regulation_market_mwh": total("up_total_offered_mwh", "down_total_offered_mwh"),
        "up_down_asymmetry_ratio": ratio(zero("up_total_offered_mwh"), zero("down_total_offered_mwh")),
    })


def renewable_impact(lake: Lake) -> DataFrame:
    green = [c for c in GREEN if not c.startswith("dam_")]
    made = lake["generation"].select(*HOUR, total(*green).alias("licensed_renewable_mwh"))
    wide = on_hour(made, lake["unlicensed_generation"].select(*HOUR, "total_unlicensed_mwh"), lake["dam_clearing"].select(*HOUR, C("matched_bids_mwh").alias("total_demand_mwh")), prices(lake))
    every = C("licensed_renewable_mwh") + zero("total_unlicensed_mwh")
    return wide.select(*HOUR, "ptf_try", "total_demand_mwh", "licensed_renewable_mwh", zero("total_unlicensed_mwh").alias("total_unlicensed_mwh"), every.alias("total_green_energy_mwh"), (C("total_demand_mwh") - every).alias("residual_load_mwh"))


def renewable_deep(lake: Lake) -> DataFrame:
    made = lake["generation"].select(*HOUR, "wind_generation_mwh", "solar_generation_mwh")
    return on_hour(made, lake["res_forecast"].select(*HOUR, "forecasted_res_mwh")).withColumn("wind_forecast_error", C("wind_generation_mwh") - C("forecasted_res_mwh"))


def res_intraday_volatility(lake: Lake) -> DataFrame:
    """Forecast errors with figures of their day; the trailing error averages 7 days, not 7 hourly rows."""
    told, made = C("forecasted_res_mwh"), C("actual_res_generation_mwh")
    hours = lake["res_forecast"].withColumns({"forecast_error_mwh": made - told, "abs_forecast_error_mwh": F.abs(made - told), "forecast_error_pct": ratio(F.abs(made - told), told) * 100})
    days = hours.groupBy("date").agg(
        (F.max(told) - F.min(told)).alias("intraday_forecast_range_mwh"), (F.max(made) - F.min(made)).alias("intraday_actual_range_mwh"), F.avg("abs_forecast_error_mwh").alias("daily_mae_mwh"), F.avg("forecast_error_pct").alias("daily_mape_pct"),
        F.avg("forecast_error_mwh").alias("daily_bias_mwh"), F.max_by("hour", F.when(made.isNotNull(), F.struct(made, -C("hour")))).alias("peak_res_hour"), F.max(made).alias("peak_res_mwh"),
    )
    days = days.withColumn("rolling_7d_mae_mwh", F.avg("daily_mae_mwh").over(Window.orderBy("date").rowsBetween(-6, 0)))
    return hours.join(day_side(days), "date")


def shift_optimizer(lake: Lake) -> DataFrame:
    """Mean price of the three shifts, and each day's cheapest and dearest eight hours in a row."""
    hours = prices(lake)
    names = {"00_08": 0, "08_16": 8, "16_24": 16}
    shifts = hours.groupBy("date").agg(*[F.avg(F.when(C("hour").between(a, a + 7), C("ptf_try"))).alias(f"vardiya_{n}_avg_ptf") for n, a in names.items()])
    ahead = Window.partitionBy("date").orderBy("hour").rowsBetween(0, 7)
    whole = hours.select("date", "hour", F.avg("ptf_try").over(ahead).alias("mean"), F.count("*").over(ahead).alias("n")).where("n = 8")
    best = whole.groupBy("date").agg(F.min(F.struct("mean", "hour")).alias("low"), F.min(F.struct((-C("mean")).alias("mean"), "hour")).alias("high"))
    ends = best.select("date", C("low.hour").alias("cheapest_8h_start_hour"), C("low.mean").alias("cheapest_8h_avg_ptf"), C("high.hour").alias("priciest_8h_start_hour"), (-C("high.mean")).alias("priciest_8h_avg_ptf"))
    return shifts.join(ends, "date", "left").withColumn("max_shift_saving_per_mwh", F.round(C("priciest_8h_avg_ptf") - C("cheapest_8h_avg_ptf"), 2))


def smf_realized(lake: Lake) -> DataFrame:
    return lake["smf"].select(*HOUR, instant_of().alias("datetime"), "smf_try")


def smf_forecast_outlook(lake: Lake, predictions: DataFrame) -> DataFrame:
    """Realised hours, and predicted ones that aren't realised yet."""
    real = smf_realized(lake).select(*HOUR, "datetime", C("smf_try").alias("value"), F.lit("realized").alias("value_source"))
    told = predictions.select(C("predicted_date").alias("date"), C("hour").cast("int").alias("hour"), instant_of("predicted_date").alias("datetime"), C("predicted_smf").alias("value"), F.lit("model").alias("value_source"))
    return real.unionByName(told.join(real, HOUR, "left_anti"))


def smf_forward_features(lake: Lake, as_of, decay_hours: float = 5.0) -> DataFrame:
    """Features of hours to come: what is known of them, and the last settled values fading into the weekly mean."""
    tables = [*SPREAD_TABLES, "load_estimation", "res_forecast", "aic", "interim_mcp"]
    hours, trades, lost = at_once(lambda: bucketed(market_hours(lake, *tables)), lambda: bucketed(trade_hours(lake)), lambda: written(outage_days(lake, as_of)))
    since = F.date_sub(F.lit(as_of).cast("date"), 14)
    load, told, capacity = C("load_estimation.forecasted_load_mwh"), C("res_forecast.forecasted_res_mwh"), C("aic.total_aic_mwh")
    usual = hours.where(C("date") >= since).groupBy("hour").agg(F.avg(told).alias("usual_res"), F.avg(capacity).alias("usual_aic"))
    smf = hours.where("smf.smf_try IS NOT NULL").select(*HOUR, "smf.smf_try")
    # The last 168 settled hours are one short top-k; the whole series is never sorted in one task.
    last = smf.orderBy(C("date").desc(), C("hour").desc()).limit(168)
    ranked = last.withColumn("n", F.row_number().over(Window.orderBy(C("date").desc(), C("hour").desc())))
    day = lambda f: f(F.when(C("n") <= 24, C("smf_try")))
    frozen = ranked.agg(F.max(F.when(C("n") == 1, instant_of())).alias("frozen_at"), F.max(F.when(C("n") == 1, C("smf_try"))).alias("now"), day(F.avg).alias("avg24"), day(F.max).alias("max24"), day(F.min).alias("min24"), F.avg("smf_try").alias("smf_rolling_avg_168h"))
    label = hours.agg(F.max_by("system_direction.system_direction", F.when(C("system_direction").isNotNull(), F.struct("date", "hour"))).alias("system_direction_lag_5h"))
    daily = lost.join(hours.where("aic IS NOT NULL").groupBy("date").agg(F.sum(capacity).alias("day_capacity")), "date", "left")
    shock = daily.select("date", "total_outage_mwh", ratio("total_outage_mwh", "day_capacity").alias("supply_shock_index"))
    shock = shock.withColumn("supply_shock_trend_7d", F.avg("supply_shock_index").over(Window.orderBy("date").rowsBetween(-6, 0)))
    later = lambda df, days, *columns: df.select(F.date_add("date", days).alias("date"), "hour", *columns)
    lag = lambda n: C("smf_try").alias(f"smf_try_lag_{n}h")
    yesterday = later(spread_of(hours, trades), 1, *[C(c).alias(n) for c, n in YESTERDAY.items() if n != "gip_gop_spread_lag24"])
    wide = on_hour(hours.where("load_estimation IS NOT NULL"), yesterday, later(smf, 1, lag(24)), later(smf, 7, lag(168)))
    wide = wide.join(F.broadcast(usual), "hour", "left").join(day_side(shock), "date", "left").crossJoin(F.broadcast(frozen)).crossJoin(F.broadcast(label))
    green, residual = F.coalesce(told, "usual_res", F.lit(0.0)), load - F.coalesce(told, "usual_res", F.lit(0.0))
    lead = F.greatest(F.lit(0), F.timestamp_diff("HOUR", C("frozen_at"), instant_of()))
    fade = lambda c: F.exp(-C("lead_hours") / decay_hours) * C(c) + (1 - F.exp(-C("lead_hours") / decay_hours)) * C("smf_rolling_avg_168h")
    return wide.withColumns({"lead_hours": lead, "datetime": instant_of()}).select(
        *HOUR, "datetime", "lead_hours", load, green.alias("forecasted_res_mwh"), residual.alias("forecasted_residual_load_mwh"),
        ratio(residual, F.coalesce(capacity, "usual_aic")).alias("capacity_utilization_ratio"), *[zero(c).alias(c) for c in ("supply_shock_index", "total_outage_mwh", "supply_shock_trend_7d", "arb_score_lag24", "yal_lag24", "yat_lag24", "net_dgp_lag24")],
        F.coalesce("pricing.ptf_try", "interim_mcp.interim_ptf_try").alias("ptf_try"), "smf_try_lag_24h", "smf_try_lag_168h", "system_direction_lag_5h", fade("now").alias("smf_try_lag_5h"), fade("avg24").alias("smf_rolling_avg_24h"), fade("max24").alias("smf_rolling_max_24h"), fade("min24").alias("smf_rolling_min_24h"), "smf_rolling_avg_168h",
    )


def lag_features(hours: DataFrame, value: str = "smf_try", label: str = "system_direction", series: list[str] | None = None) -> DataFrame:
    """Row lags and trailing statistics that never see their own row; windows run per ``series``."""
    line = Window.partitionBy(*(series or [])).orderBy(*HOUR)
    day, week, v = line.rowsBetween(-24, -1), line.rowsBetween(-168, -1), C(value)
    return hours.withColumns({
        **{f"{value}_lag_{n}h": F.lag(v, n).over(line) for n in (5, 24, 168)}, "smf_rolling_avg_24h": F.avg(v).over(day), "smf_rolling_max_24h": F.max(v).over(day), "smf_rolling_min_24h": F.min(v).over(day),
        "smf_rolling_avg_168h": F.avg(v).over(week), f"{label}_lag_5h": F.lag(label, 5).over(line),
    })


def smf_lag_features(lake: Lake, as_of) -> DataFrame:
    """The national series: one row per hour of history, so one window (8,766 rows a year) is small however much is traded."""
    return lag_features(feature_hours(lake, as_of).withColumn("datetime", instant_of()))


def supply_demand(lake: Lake) -> DataFrame:
    return lake["supply_demand_curve"].withColumn("net_supply_mwh", C("cumulative_supply_mwh") - C("cumulative_demand_mwh"))


def system_direction(lake: Lake) -> DataFrame:
    up = lake["order_up"].groupBy(*HOUR).agg(F.sum("up_regulation_delivered_mwh").alias("yal"))
    down = lake["order_down"].groupBy(*HOUR).agg(F.sum("down_regulation_delivered_mwh").alias("yat"))
    wide = on_hour(lake["smf"], prices(lake), lake["system_direction"], lake["imbalance"].select(*HOUR, "net_imbalance_mwh"), up, down)
    return wide.select(*HOUR, "system_direction", "net_imbalance_mwh", "smf_try", "ptf_try", (C("smf_try") - C("ptf_try")).alias("smf_ptf_spread_try"), zero("yal").alias("total_yal_mwh"), zero("yat").alias("total_yat_mwh"))


def daily_price(lake: Lake) -> DataFrame:
    return prices(lake).groupBy("date").agg(F.avg("ptf_try").alias("ptf_try"))


def unlicensed_impact(lake: Lake) -> DataFrame:
    made = lake["unlicensed_generation"].groupBy("date").agg(F.sum("total_unlicensed_mwh").alias("total_unlicensed_mwh"))
    return made.join(daily_price(lake), "date", "left").withColumn("estimated_market_value_try", C("total_unlicensed_mwh") * C("ptf_try"))


def weather_gip_impact(lake: Lake) -> DataFrame:
    trades = lake["idm_transactions"].groupBy("date").agg(F.sum("quantity_mwh").alias("total_gip_volume_mwh"), weighted_price().alias("gip_weighted_avg_price_try"), F.count("*").alias("total_transaction_count"))
    weather = lake["weather"].groupBy("date").agg(F.avg("temperature_celsius").alias("avg_temperature_c"), F.avg("wind_speed_kmh").alias("avg_windspeed_kmh"), F.avg("shortwave_radiation").alias("avg_solar_radiation_wm2"))
    return trades.join(daily_price(lake), "date", "left").join(weather, "date", "left").withColumn("gip_ptf_spread_try", C("gip_weighted_avg_price_try") - C("ptf_try"))


def naive_predictions(lake: Lake) -> DataFrame:
    """Stand-in for a model's output: yesterday's price of the hour and an offset by hour, with class probabilities by its sign."""
    offset = (C("hour") % 5 - 2).cast("double")
    share = lambda a, b: F.when(offset > 0, a).when(offset < 0, b).otherwise(0.2)
    return lake["smf"].select(
        F.date_add("date", 1).alias("predicted_date"), C("hour").cast("long").alias("hour"), (C("smf_try") + offset).alias("predicted_smf"), F.when(offset > 0, DEFICIT).when(offset < 0, SURPLUS).otherwise("IN_BALANCE").alias("predicted_direction"),
        share(0.6, 0.3).alias("proba_energy_deficit"), share(0.3, 0.6).alias("proba_energy_surplus"), F.when(offset == 0, 0.6).otherwise(0.1).alias("proba_in_balance"),
    )


MARTS: dict[str, Callable[[Lake], DataFrame]] = {
    "MA-1": capacity_utilization, "MA-2": company_gop_activity, "MA-3": company_production_activity, "MA-4": cross_market_spread, "MA-5": dgp_system_analysis, "MA-6": dgp_system_analysis,
    "MA-7": forecast_error, "MA-8": forecasted_residual_load, "MA-9": generation_mix, "MA-10": gip_company_activity, "MA-11": gip_hourly_reference, "MA-12": gold_monthly_executive_metrics,
    "MA-13": gop_volume_analysis, "MA-14": hydro_risk, "MA-15": imbalance_cost, "MA-16": merit_order, "MA-18": price_analysis, "MA-19": production_plan, "MA-20": ptf_drivers,
    "MA-21": ptf_extremes, "MA-22": ptf_realized, "MA-23": ptf_usd, "MA-25": renewable_impact, "MA-24": regulation_depth, "MA-26": renewable_deep, "MA-27": res_intraday_volatility,
    "MA-28": shift_optimizer, "MA-32": smf_realized, "MA-33": supply_demand, "MA-35": system_direction, "MA-36": unlicensed_impact, "MA-37": weather_gip_impact,
}
#: Marts that need a day that counts as today.
DATED_MARTS: dict[str, Callable[..., DataFrame]] = {"MA-17": ml_features, "MA-30": smf_forward_features, "MA-31": smf_lag_features, "MA-34": supply_shock_index}
