"""Operators that turn raw market rows into silver ones."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.expressions import ratio
from .keyed import keep_one

C = F.col

#: Weight of each city in the national mean of a variable.
CITY_WEIGHTS = {
    "istanbul": (0.40, 0.10, 0.10),
    "izmir": (0.20, 0.45, 0.25),
    "konya": (0.15, 0.25, 0.40),
    "ankara": (0.25, 0.20, 0.25),
}
#: Which of the three weights (consumption, wind, solar) a variable takes.
VARIABLES = {"temperature_2m": 0, "wind_speed_10m": 1, "shortwave_radiation": 2, "relative_humidity_2m": 0}


def computed_imbalance(generation: DataFrame, consumption: DataFrame, key: str = "date") -> DataFrame:
    """Generation less consumption and its direction; an hour without consumption counts as 0."""
    used = consumption.groupBy(key).agg(F.max("consumption").alias("consumption"))
    net = F.round(F.coalesce("total", F.lit(0.0)) - C("consumption"), 3)
    both = generation.join(used, key, "left").withColumn("consumption", F.coalesce("consumption", F.lit(0.0)))
    return both.select(key, F.coalesce("total", F.lit(0.0)).alias("generationTotal"), "consumption", net.alias("imbalanceQuantity")).withColumn("systemDirection", F.when(C("imbalanceQuantity") > 0, "ENERGY_SURPLUS").when(C("imbalanceQuantity") < 0, "ENERGY_DEFICIT").otherwise("BALANCED"))


def with_roster(facts: DataFrame, roster: DataFrame, key: str, max_bytes: int = 64 << 20) -> DataFrame:
    """Attach names to facts; the roster is broadcast only if its values, and 16 bytes for each, take at most ``max_bytes``."""
    values = [F.coalesce(F.octet_length(C(c).cast("string")), F.lit(0)) + 16 for c in roster.columns]
    size = roster.agg(F.sum(reduce(lambda a, b: a + b, values).cast("long"))).collect()[0][0] or 0
    return facts.join(F.broadcast(roster) if size <= max_bytes else roster, key, "left")


def unique_units(batches: DataFrame, key: str) -> DataFrame:
    return batches.select(key).distinct()


def national_weather(cities: DataFrame, weights: dict[str, tuple[float, float, float]] | None = None) -> DataFrame:
    """Weighted means over the cities that report a variable, and each city's temperature in a column."""
    weights = CITY_WEIGHTS if weights is None else weights

    def weight(i: int) -> Column:
        out = F.lit(0.0)
        for city, w in weights.items():
            out = F.when(C("city") == city, w[i]).otherwise(out)
        return out

    means = []
    for name, i in VARIABLES.items():
        held = F.when(C(name).isNotNull(), weight(i))
        means.append(ratio(F.sum(C(name) * weight(i)), F.sum(held)).alias(name))
    own = [F.max(F.when(C("city") == c, C("temperature_2m"))).alias(f"temperature_2m_{c}") for c in weights]
    return cities.groupBy("date").agg(*means, *own)


def weekdays(start, end, spark) -> DataFrame:
    """Monday to Friday of a span of days."""
    days = spark.range(1).select(F.explode(F.sequence(F.lit(start).cast("date"), F.lit(end).cast("date"))).alias("date"))
    return days.where(F.weekday("date") < 5)


def filled_rates(quotes: DataFrame, days: DataFrame, tolerance: int = 5) -> DataFrame:
    """Each day's quote, else the last one up to ``tolerance`` days old, with a flag; days beyond that get none.

    Every quote offers itself to the days that it may serve, at most ``tolerance + 1`` rows, and each day takes the
    youngest offer: an equi-join and a grouped maximum, with no ordering of the whole series.
    """
    offers = quotes.where("usdtry IS NOT NULL").select(C("date").alias("quoted"), "usdtry").withColumn("date", F.explode(F.sequence("quoted", F.date_add("quoted", tolerance))))
    best = offers.groupBy("date").agg(F.max(F.struct("quoted", "usdtry")).alias("b"))
    return days.join(best, "date", "left").select("date", C("b.usdtry").alias("usdtry"), (C("b.quoted") < C("date")).alias("is_ffilled"))


def lead_source(df: DataFrame, run_date, days: int = 1) -> DataFrame:
    """Sources that publish ahead: rows without a date of their own belong to the day after the run."""
    return df.withColumn("content_date", F.date_add(F.lit(run_date).cast("date"), days))


def fetch_window(df: DataFrame, run_date, delay_days: int = 0, lookahead_days: int = 0, column: str = "date") -> DataFrame:
    """Rows that a source publishes on a run date: up to ``delay_days`` old and ``lookahead_days`` ahead."""
    day = F.lit(run_date).cast("date")
    return df.where(F.to_date(column).between(F.date_sub(day, delay_days), F.date_add(day, lookahead_days)))


def latest_snapshot(df: DataFrame, key: str, snapshot: str = "ds") -> DataFrame:
    """The newest row of each key over dated snapshots."""
    return keep_one(df, [key], C(snapshot).desc())
