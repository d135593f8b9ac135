"""Trading signal by expected value, and its backtest, as column expressions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.expressions import expected_max, expected_min, ratio
from ..operators.keyed import HOUR
from . import marts
from .staging import Lake

C = F.col
MIN_SAMPLE = 20
TRADE, SETTLE = "TRUE_UP_GIP", "LET_SETTLE"


def residual_sigma(predictions: DataFrame, actual: DataFrame, min_sample: int = MIN_SAMPLE) -> DataFrame:
    """Standard deviation of the prediction error by predicted direction; the overall one where a class is small."""
    error = predictions.select(C("predicted_date").alias("date"), C("hour").cast("int").alias("hour"), "predicted_smf", "predicted_direction").join(actual.select(*HOUR, "smf_try"), HOUR).where("smf_try IS NOT NULL AND predicted_smf IS NOT NULL").withColumn("error", C("smf_try") - C("predicted_smf"))
    overall = error.agg(F.stddev_samp("error").alias("all"))
    classes = error.groupBy("predicted_direction").agg(F.count("*").alias("n"), F.stddev_samp("error").alias("own"))
    return classes.crossJoin(F.broadcast(overall)).select("predicted_direction", "n", F.when(C("n") < min_sample, C("all")).otherwise(C("own")).alias("sigma"))


def backtest_frame(lake: Lake, predictions: DataFrame) -> DataFrame:
    """Hours with a prediction, both prices and an intraday price."""
    told = predictions.select(C("predicted_date").alias("date"), C("hour").cast("int").alias("hour"), "predicted_smf", "predicted_direction")
    return told.join(lake["smf"], HOUR).join(lake["pricing"].select(*HOUR, "ptf_try"), HOUR).join(marts.gip_hourly_reference(lake).select(*HOUR, "gip_vwap_try"), HOUR).where("gip_vwap_try IS NOT NULL AND ptf_try IS NOT NULL AND smf_try IS NOT NULL")


def with_signals(frame: DataFrame, sigma: DataFrame) -> DataFrame:
    """Trade the imbalance intraday if that beats its expected settlement, for the short and the long side."""
    wide = frame.join(F.broadcast(sigma.select("predicted_direction", "sigma")), "predicted_direction", "left").withColumn("sigma", F.coalesce("sigma", F.lit(0.0)))
    cost = 1.03 * expected_max(C("predicted_smf"), C("sigma"), C("ptf_try"))
    value = 0.97 * expected_min(C("predicted_smf"), C("sigma"), C("ptf_try"))
    return wide.withColumns({
        "expected_short_cost": cost, "expected_long_value": value,
        "short_signal": F.when(C("gip_vwap_try") < cost, TRADE).otherwise(SETTLE), "long_signal": F.when(C("gip_vwap_try") > value, TRADE).otherwise(SETTLE),
    })


def with_outcomes(signals: DataFrame) -> DataFrame:
    """What each strategy pays for a missing MWh or gets for a spare one."""
    settle_cost, settle_value, trade = 1.03 * F.greatest("ptf_try", "smf_try"), 0.97 * F.least("ptf_try", "smf_try"), C("gip_vwap_try")
    return signals.withColumns({
        "short_settle": settle_cost, "short_trade": trade, "short_model": F.when(C("short_signal") == TRADE, trade).otherwise(settle_cost), "short_perfect": F.least(settle_cost, trade),
        "long_settle": settle_value, "long_trade": trade, "long_model": F.when(C("long_signal") == TRADE, trade).otherwise(settle_value), "long_perfect": F.greatest(settle_value, trade),
    })


def backtest(lake: Lake, predictions: DataFrame) -> DataFrame:
    return with_outcomes(with_signals(backtest_frame(lake, predictions), residual_sigma(predictions, lake["smf"])))


def summary(tested: DataFrame) -> DataFrame:
    """Mean outcomes, edges over settling and the mix of signals."""
    means = [F.avg(f"{s}_{k}").alias(f"mean_{s}_{k}") for s in ("short", "long") for k in ("settle", "trade", "model", "perfect")]
    return tested.agg(
        F.count("*").alias("n_hours"), *means, F.avg(C("short_settle") - C("short_model")).alias("short_edge"), F.avg(C("long_model") - C("long_settle")).alias("long_edge"),
        (F.count_if(C("short_signal") == TRADE) / F.count("*")).alias("short_trade_share"), (F.count_if(C("long_signal") == TRADE) / F.count("*")).alias("long_trade_share"),
    )


def daily_edge(tested: DataFrame) -> DataFrame:
    """Per day the gain over settling, whether it is a win, and what perfect foresight would add."""
    gain = (C("short_settle") - C("short_model")) + (C("long_model") - C("long_settle"))
    gap = (C("short_model") - C("short_perfect")) + (C("long_perfect") - C("long_model"))
    return tested.groupBy("date").agg(F.sum(gain).alias("edge"), F.sum(gap).alias("gap_to_perfect"), F.count("*").alias("n_hours")).withColumn("win", C("edge") > 0)


def win_rate(tested: DataFrame) -> DataFrame:
    return daily_edge(tested).agg(F.count("*").alias("n_days"), ratio(F.count_if("win"), F.count("*")).alias("win_rate"), F.avg("edge").alias("mean_edge"), F.avg("gap_to_perfect").alias("mean_gap"))


def live_signal(lake: Lake, predictions: DataFrame, as_of) -> DataFrame:
    """Signals for predicted hours that aren't settled, at the usual intraday price of the hour over the last 7 days."""
    usual = marts.gip_hourly_reference(lake).where(C("date") >= F.date_sub(F.lit(as_of).cast("date"), 7)).groupBy("hour").agg(F.avg("gip_vwap_try").alias("gip_vwap_try"))
    spread = residual_sigma(predictions, lake["smf"]).agg(F.avg("sigma").alias("sigma"))
    ahead = predictions.select(C("predicted_date").alias("date"), C("hour").cast("int").alias("hour"), "predicted_smf", "predicted_direction", F.greatest("proba_energy_deficit", "proba_energy_surplus", "proba_in_balance").alias("confidence"))
    open_hours = ahead.join(lake["smf"].select(*HOUR), HOUR, "left_anti").join(marts.ptf_realized(lake).select(*HOUR, "ptf_try"), HOUR).where("ptf_try IS NOT NULL")
    priced = open_hours.join(F.broadcast(usual), "hour").crossJoin(F.broadcast(spread))
    cost = 1.03 * expected_max(C("predicted_smf"), C("sigma"), C("ptf_try"))
    value = 0.97 * expected_min(C("predicted_smf"), C("sigma"), C("ptf_try"))
    return priced.select(*HOUR, "predicted_smf", "predicted_direction", "confidence", "ptf_try", "gip_vwap_try", F.when(C("gip_vwap_try") < cost, TRADE).otherwise(SETTLE).alias("short_signal"), F.when(C("gip_vwap_try") > value, TRADE).otherwise(SETTLE).alias("long_signal"))
