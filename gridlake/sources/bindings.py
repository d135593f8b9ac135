"""Silver-form market tables made from the star-schema test tables, so that every model runs on data that grows.

Hourly sources come from ``events``: one row per UTC hour and user parity, hence up to two rows per market hour, which
staging has to settle. Company, reservoir and outage sources come from ``lineitem`` and what it joins to.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import dealt, written

TYPES = ["view", "purchase", "click", "signup", "error"]
#: Fuel columns of the plan tables, in the order in which test data fills them.
PLAN_FUELS = ["dogalgaz", "ruzgar", "linyit", "tasKomur", "ithalKomur", "fuelOil", "jeotermal", "barajli", "nafta", "biokutle", "akarsu", "gunes", "diger"]
GENERATION_FUELS = ["naturalGas", "dammedHydro", "lignite", "river", "importCoal", "wind", "sun", "fueloil", "geothermal", "asphaltiteCoal", "blackCoal", "biomass", "naphta", "lng", "importExport", "wasteheat"]
UNLICENSED = ["ruzgar", "gunes", "biyokutle", "biyogaz", "kanalTipi", "diger"]
BANDS = 16
#: Event values have two decimals; scaled, no mean of them lies on a rounding edge, where engines differ.
SCALE = 1.0003712345
#: Dates of the star schema move to where the events are.
YEARS_ON = 27


def recent(c: str) -> Column:
    return F.col(c).cast("timestamp") + F.make_ym_interval(F.lit(YEARS_ON))


@dataclass(frozen=True)
class Hourly:
    """A source that is a selection of the hourly sums: which of them, and its columns beside the time."""

    condition: str
    columns: tuple[Column, ...]

    def all_columns(self) -> list[str | Column]:
        return ["date", "hour", "time", *self.columns, "_record_hash"]


class Silver:
    """Silver tables by name, each built when it is asked for."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir
        self._built: dict[str, DataFrame] = {}
        self._hours: DataFrame | None = None

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._built:
            made = getattr(self, f"_{name}")()
            self._built[name] = self.hours().where(made.condition).select(*made.all_columns()) if isinstance(made, Hourly) else made
        return self._built[name]

    def side_by_side(self, names: list[str]) -> DataFrame:
        """Hourly sources beside each other, one scan for all: a struct for each, null in rows that aren't its own."""
        made = {n: getattr(self, f"_{n}")() for n in names}
        return self._summed().select(*[F.when(F.expr(m.condition), F.struct(*m.all_columns())).alias(n) for n, m in made.items()])

    def events(self) -> DataFrame:
        return self.table("events").select("event_id", F.col("ts").cast("timestamp").alias("ts"), "user_id", "event_type", (F.col("value") * SCALE).alias("value"), F.get_json_object("props", "$.k").cast("int").alias("k"))

    def hours(self) -> DataFrame:
        """Sums by UTC hour and user parity, written once: events are scanned once, however many tables are made from them."""
        if self._hours is None:
            self._hours = written(self._summed())
        return self._hours

    def _summed(self) -> DataFrame:
        kind = lambda t: F.col("event_type") == t
        per = [F.sum(F.when(kind(t), F.col("value"))).alias(f"sum_{t}") for t in TYPES] + [F.avg(F.when(kind(t), F.col("value"))).alias(f"avg_{t}") for t in ("view", "purchase")]
        bands = [F.sum(F.when(F.col("k") % BANDS == i, F.col("value"))).alias(f"band{i}") for i in range(BANDS)]
        coded = [F.sum(F.when(kind(t) & (F.col("k") % 3 == i), F.col("value"))).alias(f"{t}{i}") for t in ("error", "click") for i in range(3)]
        grouped = self.events().groupBy(F.date_trunc("hour", "ts").alias("date"), (F.col("user_id") % 2).alias("parity")).agg(F.sum("value").alias("every"), *per, *bands, *coded)
        clock = F.date_format(F.from_utc_timestamp("date", "Asia/Istanbul"), "HH:00")
        return grouped.withColumns({"hour": clock, "time": clock, "_record_hash": F.md5(F.concat_ws("|", F.unix_timestamp("date"), "parity"))})

    def _hourly(self, condition: str, *columns: Column) -> Hourly:
        return Hourly(condition, columns)

    def _pricing(self) -> Hourly:
        usd = F.when(F.hour("date") % 6 != 5, F.col("avg_view") / 32)
        return self._hourly("sum_view IS NOT NULL", F.col("avg_view").alias("price"), usd.alias("priceUsd"), (F.col("avg_view") / 35).alias("priceEur"))

    def _interim_mcp(self) -> Hourly:
        return self._hourly("sum_click IS NOT NULL AND parity = 0", (F.coalesce("avg_view", "avg_purchase", F.lit(50.0)) * 1.01).alias("marketTradePrice"))

    def _smf(self) -> Hourly:
        return self._hourly("sum_purchase IS NOT NULL", F.col("avg_purchase").alias("systemMarginalPrice"))

    def _consumption(self) -> Hourly:
        return self._hourly("true", (F.col("every") * 0.98).alias("consumption"))

    def _load_estimation(self) -> Hourly:
        return self._hourly("true", F.col("every").alias("lep"))

    def _res_forecast(self) -> Hourly:
        return self._hourly("sum_signup IS NOT NULL OR sum_click IS NOT NULL", F.col("sum_signup").alias("forecast"), F.col("sum_click").alias("generation"))

    def _generation(self) -> Hourly:
        return self._hourly("true", F.col("every").alias("total"), *[F.col(f"band{i}").alias(f) for i, f in enumerate(GENERATION_FUELS)])

    def _plan(self, condition: str, factor: float, fuels: list[str]) -> Hourly:
        return self._hourly(condition, (F.col("every") * factor).alias("toplam"), *[(F.col(f"band{i}") * factor).alias(f) for i, f in enumerate(fuels)])

    def _aic(self) -> Hourly:
        return self._plan("true", 2.0, PLAN_FUELS[:-1])

    def _dpp(self) -> Hourly:
        return self._plan("sum_view IS NOT NULL", 1.0, PLAN_FUELS)

    def _sbfgp(self) -> Hourly:
        return self._plan("parity = 1", 1.05, PLAN_FUELS)

    def _unlicensed(self) -> Hourly:
        return self._plan("sum_click IS NOT NULL", 0.1, UNLICENSED)

    def _imbalance(self) -> Hourly:
        made, used = F.coalesce("sum_click", F.lit(0.0)) + F.coalesce("sum_signup", F.lit(0.0)), F.coalesce("sum_view", F.lit(0.0)) + F.coalesce("sum_purchase", F.lit(0.0))
        return self._hourly("true", made.alias("generationTotal"), used.alias("consumption"), F.round(made - used, 3).alias("imbalanceQuantity"))

    def _system_direction(self) -> Hourly:
        net = F.round(F.coalesce("sum_click", F.lit(0.0)) + F.coalesce("sum_signup", F.lit(0.0)) - F.coalesce("sum_view", F.lit(0.0)) - F.coalesce("sum_purchase", F.lit(0.0)), 3)
        label = F.when(net < 0, "Enerji Açığı").when(net > 0, "Enerji Fazlası").otherwise("Dengede")
        return self._hourly("sum_view IS NOT NULL OR sum_click IS NOT NULL", label.alias("systemDirection"))

    def _order(self, kind: str, side: str) -> Hourly:
        coded = [F.col(f"{kind}{i}").alias(f"{side}Regulation{n}Coded") for i, n in enumerate(("Zero", "One", "Two"))]
        return self._hourly(f"sum_{kind} IS NOT NULL", *coded, (F.col(f"sum_{kind}") * 0.8).alias(f"{side}RegulationDelivered"), (F.col(f"sum_{kind}") - F.col("every") * 0.1).alias("net"))

    def _order_up(self) -> Hourly:
        return self._order("error", "up")

    def _order_down(self) -> Hourly:
        return self._order("click", "down")

    def _price_ind_bid(self) -> Hourly:
        return self._hourly("sum_view IS NOT NULL", (F.col("sum_view") * 0.5).alias("bidVolume"))

    def _dam_clearing(self) -> Hourly:
        return self._hourly("true", (F.coalesce("sum_view", F.lit(0.0)) + F.coalesce("sum_click", F.lit(0.0))).alias("matchedBids"), (F.coalesce("sum_purchase", F.lit(0.0)) + F.coalesce("sum_signup", F.lit(0.0))).alias("matchedOffers"))

    def _idm_transactions(self) -> DataFrame:
        """Trades; every tenth came again an hour later with the same id."""
        trade = self.events().select(F.col("event_id").alias("id"), F.col("ts").alias("date"), F.col("event_type").alias("contractName"), F.col("value").alias("price"), (1 + F.col("k") % 10).cast("double").alias("quantity"))
        later = trade.where("id % 10 = 0").withColumn("date", F.col("date") + F.expr("interval 1 hour"))
        both = trade.unionByName(later)
        return both.withColumns({"hour": F.date_format(F.from_utc_timestamp("date", "Asia/Istanbul"), "HH:00"), "_record_hash": F.md5(F.concat_ws("|", "id", F.unix_timestamp("date")))})

    def _weather(self) -> DataFrame:
        value = self.events().groupBy(F.date_trunc("hour", "ts").alias("date"), F.concat(F.lit("city"), F.col("user_id") % 4).alias("city"))
        return value.agg(F.avg("value").alias("temperature_2m"), F.max("value").alias("wind_speed_10m"), F.sum("value").alias("shortwave_radiation"), F.min("value").alias("relative_humidity_2m"))

    def _outages(self) -> DataFrame:
        """Spans that end before they start stay in, for models to drop."""
        lines = self.table("lineitem").select(F.col("l_orderkey").alias("o_orderkey"), "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", recent("l_shipdate").alias("shipped"))
        orders = self.table("orders").select("o_orderkey", recent("o_orderdate").alias("ordered"))
        both = lines.join(orders, "o_orderkey")
        return both.select(
            (F.col("o_orderkey") * 10 + F.col("l_linenumber")).alias("id"), F.col("ordered").alias("caseStartDate"), F.least("shipped", F.col("ordered") + F.expr("interval 30 days")).alias("caseEndDate"),
            F.concat(F.lit("org"), F.col("l_suppkey")).alias("orgName"), F.concat(F.lit("plant"), F.col("l_partkey")).alias("powerPlantName"), (F.col("l_quantity") * 2).alias("operatorPower"), F.col("l_quantity").alias("capacityAtCaseTime"),
            F.concat(F.lit("reason"), F.col("l_linenumber")).alias("reason"), F.md5(F.concat_ws("|", "o_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.col("l_quantity").cast("int"))).alias("_record_hash"),
        )

    def _dams(self) -> DataFrame:
        places = self.table("supplier").join(self.table("nation"), F.col("s_nationkey") == F.col("n_nationkey")).join(self.table("region"), F.col("n_regionkey") == F.col("r_regionkey")).select("s_suppkey", "s_name", "r_name")
        lines = self.table("lineitem")
        # By reservoir alone, so that later steps by (date, reservoir) and by reservoir need no exchange of their own.
        shipped = dealt(lines.select(recent("l_shipdate").alias("date"), F.col("l_suppkey").alias("s_suppkey"), "l_quantity"), lines.count(), "s_suppkey")
        level = shipped.groupBy("date", "s_suppkey").agg(F.sum("l_quantity").alias("activeVolume"))
        named = level.join(places, "s_suppkey")
        return named.select("date", F.col("s_suppkey").alias("damId"), F.col("r_name").alias("basinName"), F.col("s_name").alias("damName"), "activeVolume", F.md5(F.concat_ws("|", F.unix_timestamp("date"), "s_suppkey")).alias("_record_hash"))

    def _lines(self, *keys: str) -> DataFrame:
        hour = F.col("l_partkey") % 24
        lines = self.table("lineitem")
        # While rows are narrow, so that dedup by keys that hold these needs no exchange of wide rows.
        lines = dealt(lines, lines.count(), *keys) if keys else lines
        lines = lines.join(self.table("supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
        # Shipping days begin at Istanbul midnight.
        at = recent("l_shipdate") + F.make_dt_interval(hours=(hour - 3).cast("int"))
        return lines.withColumns({"date": at, "time": F.concat(F.lpad(hour.cast("string"), 2, "0"), F.lit(":00")), "_record_hash": F.md5(F.concat_ws("|", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.col("l_quantity").cast("int")))})

    def _dam_clearing_by_org(self) -> DataFrame:
        bid = F.col("l_returnflag") == "A"
        return self._lines().select("date", F.col("time").alias("hour"), F.col("l_suppkey").alias("organizationId"), F.col("s_name").alias("organizationName"), F.when(bid, F.col("l_quantity")).otherwise(0.0).alias("matchedBids"), F.when(~bid, F.col("l_quantity")).otherwise(0.0).alias("matchedOffers"), "_record_hash")

    def _kgup_bulk_by_org(self) -> DataFrame:
        fuels = [F.when(F.col("l_linenumber") % len(PLAN_FUELS) == i, F.col("l_quantity")).otherwise(0.0).alias(f) for i, f in enumerate(PLAN_FUELS)]
        return self._lines("l_suppkey", "l_partkey").select("date", "time", F.col("l_suppkey").alias("orgId"), F.col("l_partkey").alias("uevcbId"), F.concat(F.lit("unit"), F.col("l_partkey")).alias("uevcbName"), F.col("l_quantity").alias("toplam"), *fuels, "_record_hash")

    def _supply_demand(self) -> DataFrame:
        part = self.table("part")
        at = F.expr("timestamp '2023-12-31 21:00:00'") + F.make_dt_interval(days=(F.col("p_partkey") % 30).cast("int"), hours=(F.col("p_size") % 24).cast("int"))
        return part.select(at.alias("date"), F.col("p_retailprice").alias("price"), (F.col("p_size") * 10.0).alias("supply"), (600.0 - F.col("p_size") * 10.0).alias("demand"), F.md5(F.col("p_partkey").cast("string")).alias("_record_hash"))

    def _fx_rates(self) -> DataFrame:
        """Mean order totals of working days."""
        daily = self.table("orders").groupBy(F.to_date(recent("o_orderdate")).alias("date")).agg((F.avg("o_totalprice") / 5000).alias("usdtry"))
        return daily.where(F.weekday("date") < 5).select("date", "usdtry", F.lit(False).alias("is_ffilled"), F.lit("orders").alias("source"))

    def _participants(self) -> DataFrame:
        return self.table("supplier").select(F.col("s_suppkey").cast("double").alias("id"), F.col("s_name").alias("orgName"), F.concat(F.lit("C"), F.col("s_suppkey")).alias("orgCode"), F.concat(F.lit("E"), F.col("s_suppkey")).alias("eicCode"), F.when(F.col("s_acctbal") > 0, "A").otherwise("B").alias("legalStatus"))
