"""Result tables of the serving layer: what dashboards read, without the dashboards."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.expressions import DEFICIT, instant_of, ratio
from ..operators import sketches
from ..operators.keyed import HOUR
from . import marts
from .staging import Lake

C = F.col
CLASSES = [DEFICIT, "ENERGY_SURPLUS", "IN_BALANCE"]


def means(df: DataFrame, by: list[Column | str], *columns: str) -> DataFrame:
    return df.groupBy(*by).agg(*[F.avg(c).alias(f"mean_{c}") for c in columns], F.count("*").alias("n"))


def monthly(df: DataFrame, *columns: str, at: str = "date") -> DataFrame:
    return means(df, [F.date_format(at, "yyyy-MM").alias("year_month")], *columns)


def hourly(df: DataFrame, *columns: str) -> DataFrame:
    return means(df, ["hour"], *columns)


def month_on_month(lake: Lake) -> DataFrame:
    by = Window.orderBy("year_month")
    months = monthly(lake["pricing"], "ptf_try")
    return months.withColumn("previous", F.lag("mean_ptf_try").over(by)).withColumn("change_pct", ratio(C("mean_ptf_try") - C("previous"), "previous") * 100)


def season_by_year(lake: Lake) -> DataFrame:
    prices = marts.price_analysis(lake)
    return prices.groupBy(F.year("date").alias("year")).pivot("season", ["Kış", "İlkbahar", "Yaz", "Sonbahar"]).agg(F.avg("ptf_try"))


def year_on_year(lake: Lake) -> DataFrame:
    """Reservoir volume of each month beside that of the year before."""
    months = lake["dams"].groupBy(F.year("date").alias("year"), F.month("date").alias("month")).agg(F.sum("active_volume").alias("volume"))
    before = months.select((C("year") + 1).alias("year"), "month", C("volume").alias("volume_before"))
    return months.join(before, ["year", "month"], "left").withColumn("change_pct", ratio(C("volume") - C("volume_before"), "volume_before") * 100)


def season_spread(lake: Lake) -> DataFrame:
    return means(marts.price_analysis(lake), ["season"], "price_spread")


def week_grid(lake: Lake) -> DataFrame:
    """Mean price by day of the week and hour."""
    return lake["pricing"].groupBy(F.dayofweek("date").alias("day_of_week")).pivot("hour", list(range(24))).agg(F.avg("ptf_try")).withColumnsRenamed({str(h): f"h{h}" for h in range(24)})


def histogram(df: DataFrame, value: str, width: float, by: list[str] | None = None) -> DataFrame:
    """Rows per bin of fixed width (and class)."""
    return df.where(C(value).isNotNull()).groupBy(*(by or []), (F.floor(C(value) / width) * width).cast("double").alias("bin")).agg(F.count("*").alias("n"))


def settlement_means(lake: Lake) -> DataFrame:
    return means(marts.price_analysis(lake), ["date"], "deficit_settlement_price", "surplus_settlement_price")


def block_by_hour(lake: Lake) -> DataFrame:
    return means(marts.price_analysis(lake), ["price_block", "hour"], "ptf_try")


def low_price_hours(lake: Lake, at_most: float = 20.0) -> DataFrame:
    return lake["pricing"].groupBy("hour").agg(F.count_if(C("ptf_try") <= at_most).alias("low_hours"), F.count_if(C("ptf_try") == 0).alias("zero_hours"), F.count("*").alias("n"))


def seeded_sample(df: DataFrame, keys: list[str], rows: int = 500, seed: str = "7") -> DataFrame:
    """The same ``rows`` rows on every run: those with the least hash of key and seed."""
    return df.withColumn("_at", F.md5(F.concat_ws("|", *keys, F.lit(seed)))).orderBy("_at", *keys).limit(rows).drop("_at")


def monthly_mix(lake: Lake) -> DataFrame:
    return monthly(marts.generation_mix(lake), "total_generation", "renewable_ratio", "fossil_ratio")


def renewable_price_correlation(lake: Lake) -> DataFrame:
    return marts.generation_mix(lake).join(lake["pricing"].select(*HOUR, "ptf_try"), HOUR).agg(F.corr("renewable_ratio", "ptf_try").alias("correlation"), F.count("*").alias("n"))


def market_value(lake: Lake) -> DataFrame:
    return marts.gop_volume_analysis(lake).groupBy("date").agg(F.sum("market_volume_try").alias("market_value_try"), F.sum("total_buy_mwh").alias("total_buy_mwh"), F.sum("total_sell_mwh").alias("total_sell_mwh"))


def buy_sell_profile(lake: Lake) -> DataFrame:
    return hourly(marts.gop_volume_analysis(lake), "total_buy_mwh", "total_sell_mwh")


def latest_day(df: DataFrame) -> DataFrame:
    return df.join(F.broadcast(df.agg(F.max("date").alias("date"))), "date")


def merit_split(lake: Lake) -> DataFrame:
    """Points in and out of merit on the last day of the curve."""
    return latest_day(marts.merit_order(lake)).groupBy("date", "supply_status").agg(F.count("*").alias("n"), F.avg("bid_offer_price_try").alias("mean_price"))


def independent_share(lake: Lake) -> DataFrame:
    bids = lake["price_ind_bid"].groupBy("date").agg(F.sum("price_independent_bid_mwh").alias("independent_mwh"))
    volume = lake["dam_clearing"].groupBy("date").agg(F.sum("matched_bids_mwh").alias("matched_mwh"))
    return volume.join(bids, "date", "left").withColumn("share_pct", ratio("independent_mwh", "matched_mwh") * 100)


def top_companies(lake: Lake, rows: int = 10) -> DataFrame:
    per = marts.company_gop_activity(lake).groupBy("organization_id", "organization_name").agg(F.sum("total_volume_mwh").alias("total_volume_mwh"), F.sum("net_position_mwh").alias("net_position_mwh"), F.sum("active_hours").alias("active_hours"))
    return per.orderBy(C("total_volume_mwh").desc(), "organization_id").limit(rows)


def top_producers(lake: Lake, rows: int = 10) -> DataFrame:
    fuels = ["natural_gas_mwh", "wind_mwh", "hydro_mwh", "solar_mwh", "coal_mwh"]
    per = marts.company_production_activity(lake).groupBy("org_id", "organization_name").agg(F.sum("total_kgup_mwh").alias("total_kgup_mwh"), *[F.sum(f).alias(f) for f in fuels])
    return per.orderBy(C("total_kgup_mwh").desc(), "org_id").limit(rows)


def residual_profile(lake: Lake) -> DataFrame:
    return hourly(marts.forecasted_residual_load(lake), "forecasted_load_mwh", "forecasted_res_mwh", "forecasted_residual_load_mwh")


def residual_monthly(lake: Lake) -> DataFrame:
    return monthly(marts.forecasted_residual_load(lake), "forecasted_load_mwh", "forecasted_res_mwh", "forecasted_residual_load_mwh")


def shock_months(lake: Lake, as_of, threshold: float = 1.0) -> DataFrame:
    shock = marts.supply_shock_index(lake, as_of)
    return shock.groupBy(F.date_format("date", "yyyy-MM").alias("year_month")).agg(F.avg("total_outage_mwh").alias("mean_outage_mwh"), F.avg("supply_shock_index").alias("mean_shock"), F.count_if(C("supply_shock_index") > threshold).alias("risk_days"), F.count("*").alias("n"))


def outlook_spine(lake: Lake, predictions: DataFrame, now, back: int = 7, ahead: int = 16) -> DataFrame:
    """The hours around ``now`` with the settled price or else the predicted one, and which it is."""
    at = F.lit(now).cast("timestamp")
    hours = lake.silver.spark.range(1).select(F.explode(F.sequence(at - F.make_dt_interval(hours=F.lit(back)), at + F.make_dt_interval(hours=F.lit(ahead)), F.expr("interval 1 hour"))).alias("datetime"))
    real = marts.smf_realized(lake).select("datetime", "smf_try")
    told = predictions.select(instant_of("predicted_date").alias("datetime"), "predicted_smf")
    wide = F.broadcast(hours).join(real, "datetime", "left").join(told, "datetime", "left")
    source = F.when(C("smf_try").isNotNull(), "realized").when(C("predicted_smf").isNotNull(), "model").otherwise("none")
    return wide.withColumns({"value": F.coalesce("smf_try", "predicted_smf"), "value_source": source})


def lag_correlations(lake: Lake) -> DataFrame:
    lagged = marts.lag_features(lake["smf"].join(lake["system_direction"], HOUR, "left"))
    return lagged.agg(*[F.corr("smf_try", f"smf_try_lag_{n}h").alias(f"corr_{n}h") for n in (5, 24, 168)])


def confusion(lake: Lake, predictions: DataFrame) -> DataFrame:
    """Actual against predicted class with every class in both, also those without rows."""
    told = predictions.select(C("predicted_date").alias("date"), C("hour").cast("int").alias("hour"), "predicted_direction")
    seen = told.join(lake["system_direction"], HOUR).groupBy("system_direction").pivot("predicted_direction", CLASSES).agg(F.count(F.lit(1)))
    spine = lake.silver.spark.range(1).select(F.explode(F.array(*[F.lit(c) for c in CLASSES])).alias("system_direction"))
    return spine.join(seen, "system_direction", "left").na.fill(0, CLASSES)


def last_week(lake: Lake) -> DataFrame:
    """The last 7 days of the balancing price, hour by hour, with the missing hours."""
    end = lake["smf"].agg(F.max("date").alias("b"))
    spine = end.select(F.explode(F.sequence(F.date_sub("b", 6), C("b"))).alias("date")).select("date", F.explode(F.sequence(F.lit(0), F.lit(23))).alias("hour"))
    return spine.join(lake["smf"], HOUR, "left").withColumn("missing", C("smf_try").isNull())


def unlicensed_totals(lake: Lake) -> DataFrame:
    return marts.unlicensed_impact(lake).agg(F.sum("total_unlicensed_mwh").alias("total_mwh"), F.sum("estimated_market_value_try").alias("total_value_try"), F.corr("total_unlicensed_mwh", "ptf_try").alias("correlation"))


def intraday_profile(lake: Lake) -> DataFrame:
    return hourly(marts.gip_hourly_reference(lake), "gip_vwap_try", "gip_volume_mwh")


def weather_price(lake: Lake) -> DataFrame:
    return marts.weather_gip_impact(lake).agg(*[F.corr(c, "ptf_try").alias(f"corr_{c}") for c in ("avg_temperature_c", "avg_windspeed_kmh", "avg_solar_radiation_wm2")])


def plan_days(lake: Lake) -> DataFrame:
    return means(marts.production_plan(lake), ["date"], "kgup_total_mwh", "kudup_total_mwh", "intraday_revision_mwh")


def revision_counts(lake: Lake) -> DataFrame:
    return marts.production_plan(lake).groupBy("revision_direction").agg(F.count("*").alias("n"), F.avg("intraday_revision_mwh").alias("mean_revision_mwh"))


def extreme_counts(lake: Lake) -> DataFrame:
    return marts.ptf_extremes(lake).groupBy("ptf_category", "extreme_driver").agg(F.count("*").alias("n"), F.avg("ptf_try").alias("mean_ptf"))


def extreme_hours(lake: Lake) -> DataFrame:
    return marts.ptf_extremes(lake).groupBy("hour").agg(F.count_if(C("ptf_category") == "TAVAN").alias("ceiling"), F.count_if(C("ptf_category") == "MINIMUM").alias("minimum"))


def cascade_counts(lake: Lake) -> DataFrame:
    return marts.cross_market_spread(lake).groupBy(F.date_format("date", "yyyy-MM").alias("year_month"), "price_cascade").agg(F.count("*").alias("n"))


def spread_profile(lake: Lake) -> DataFrame:
    return hourly(marts.cross_market_spread(lake), "gip_gop_spread_try", "smf_gop_spread_try", "yal_delivered_mwh", "yat_delivered_mwh")


def arbitrage_days(lake: Lake) -> DataFrame:
    return marts.cross_market_spread(lake).groupBy("date").agg(F.avg("arbitrage_opportunity_score").alias("mean_score"), F.max("arbitrage_opportunity_score").alias("max_score"), F.count_if(C("arbitrage_opportunity_score") > 0.1).alias("high_hours"))


def error_months(lake: Lake) -> DataFrame:
    """Forecast error of each month: mean, bias and the five figures of a box plot."""
    boxes = F.percentile("forecast_error_mwh", F.array(*[F.lit(p) for p in (0.0, 0.25, 0.5, 0.75, 1.0)]))
    months = marts.forecast_error(lake).groupBy(F.date_format("date", "yyyy-MM").alias("year_month")).agg(F.avg("abs_error_mwh").alias("mae"), F.avg("forecast_error_mwh").alias("bias"), boxes.alias("p"))
    return months.select("year_month", "mae", "bias", *[C("p")[i].alias(f"p{q}") for i, q in enumerate((0, 25, 50, 75, 100))])


def error_boxes(lake: Lake, path: str | None = None) -> DataFrame:
    """Box figures of each month's forecast error from daily sketches: whiskers, quartiles and median are values that occur."""
    errors = marts.forecast_error(lake).where("forecast_error_mwh IS NOT NULL AND date IS NOT NULL").select("date", "forecast_error_mwh")
    daily = sketches.kept(errors, "forecast_error_mwh", path) if path else sketches.made(errors, "forecast_error_mwh", ["date"])
    months = sketches.merged(daily, [F.date_format("date", "yyyy-MM").alias("year_month")])
    shares = {"p5": 0.05, "p25": 0.25, "p50": 0.5, "p75": 0.75, "p95": 0.95}
    boxed = months.withColumn("q", sketches.quantiles(list(shares.values())))
    return boxed.select("year_month", "n", ratio("total", "n").alias("bias"), *[C("q")[i].alias(n) for i, n in enumerate(shares)])


def error_kpis(lake: Lake) -> DataFrame:
    """One row: means of the daily errors, share of hours forecast too high, mean absolute error."""
    hours = marts.forecast_error(lake)
    days = hours.groupBy("date").agg(F.max("daily_rmse_mwh").alias("rmse"), F.max("daily_mape_pct").alias("mape")).agg(F.avg("rmse").alias("mean_daily_rmse_mwh"), F.avg("mape").alias("mean_daily_mape_pct"))
    over = F.avg((C("error_direction") == "Aşırı Tahmin").cast("double")) * 100
    return days.crossJoin(F.broadcast(hours.agg(over.alias("over_forecast_pct"), F.avg("abs_error_mwh").alias("mean_abs_error_mwh"), F.count("*").alias("n"))))


def intraday_months(lake: Lake) -> DataFrame:
    """Intraday trade of each month: mean hourly volume and price, transactions."""
    hours = marts.gip_hourly_reference(lake)
    return hours.groupBy(F.date_format("date", "yyyy-MM").alias("year_month")).agg(
        F.avg("gip_volume_mwh").alias("mean_volume_mwh"), F.sum("gip_volume_mwh").alias("volume_mwh"), F.avg("gip_vwap_try").alias("mean_vwap_try"), F.sum("gip_transaction_count").alias("transactions"), F.count("*").alias("n")
    )


def revision_sources(lake: Lake) -> DataFrame:
    """Mean intraday revision of wind, sun and reservoirs by hour of the day."""
    return hourly(marts.production_plan(lake), "wind_revision_mwh", "solar_revision_mwh", "hydro_revision_mwh")


def extreme_months(lake: Lake) -> DataFrame:
    """Hours of each month at the floor and at the ceiling, also months without any."""
    return marts.ptf_extremes(lake).groupBy(F.date_format("date", "yyyy-MM").alias("year_month")).agg(F.count_if(C("ptf_category") == "MINIMUM").alias("minimum"), F.count_if(C("ptf_category") == "TAVAN").alias("ceiling"))


def error_profile(lake: Lake) -> DataFrame:
    return hourly(marts.forecast_error(lake), "forecast_error_mwh", "abs_error_mwh")


def stress_buckets(lake: Lake) -> DataFrame:
    index = C("hydro_stress_index")
    bucket = F.when(index.isNull(), "none").when(index < 0.2, "critical").when(index < 0.4, "low").when(index < 0.7, "normal").otherwise("high")
    return latest_day(marts.hydro_risk(lake)).groupBy("date", bucket.alias("bucket")).agg(F.count("*").alias("n_dams"), F.sum("active_volume").alias("volume"))


def volume_movers(lake: Lake, rows: int = 10) -> DataFrame:
    moved = marts.hydro_risk(lake).where("wow_volume_change_pct IS NOT NULL")
    return moved.orderBy("wow_volume_change_pct", "date", "dam_id").limit(rows).select("date", "dam_id", "dam_name", "wow_volume_change", "wow_volume_change_pct")


def basin_days(lake: Lake) -> DataFrame:
    return marts.hydro_risk(lake).groupBy("date").agg(F.sum("active_volume").alias("volume"), F.avg("hydro_stress_index").alias("mean_stress"))


def shift_starts(lake: Lake) -> DataFrame:
    return marts.shift_optimizer(lake).where("cheapest_8h_start_hour IS NOT NULL").groupBy("cheapest_8h_start_hour").agg(F.count("*").alias("n_days"), F.avg("max_shift_saving_per_mwh").alias("mean_saving"))


def shift_months(lake: Lake) -> DataFrame:
    return monthly(marts.shift_optimizer(lake), "vardiya_00_08_avg_ptf", "vardiya_08_16_avg_ptf", "vardiya_16_24_avg_ptf", "max_shift_saving_per_mwh")


def shift_advice(lake: Lake) -> DataFrame:
    """The shift figures of the last day with all its hours."""
    whole = lake["pricing"].groupBy("date").agg(F.count_distinct("hour").alias("n")).where("n = 24").agg(F.max("date").alias("date"))
    return marts.shift_optimizer(lake).join(F.broadcast(whole), "date")


def freshest(lake: Lake) -> DataFrame:
    return lake["pricing"].agg(F.max("date").alias("freshest"))


def smf_days(lake: Lake) -> DataFrame:
    """Daily mean of the balancing price and of its 24-hour trailing mean."""
    rolled = lake["smf"].withColumn("rolling_24h", F.avg("smf_try").over(Window.orderBy(*HOUR).rowsBetween(-23, 0)))
    return rolled.groupBy("date").agg(F.avg("smf_try").alias("mean_smf"), F.avg("rolling_24h").alias("mean_rolling_24h"))
