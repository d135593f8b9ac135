"""Staging: silver rows to one typed row per key. A model is a row of ``MODELS``; one function runs them all."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.expressions import DIRECTION_LABELS, local_date, local_hour, text_hour
from ..operators.keyed import HOUR, keep_one
from ..sources.bindings import Silver


@dataclass(frozen=True)
class Model:
    """``columns`` names new columns by their silver column; ``key`` and ``latest`` set dedup, ``fold`` an aggregate instead."""

    source: str
    columns: dict[str, str]
    key: list[str] = field(default_factory=lambda: list(HOUR))
    clock: str | None = None
    day: str = "local"
    types: dict[str, str] = field(default_factory=dict)
    fold: str | None = None
    latest: str | None = "date"
    not_null: tuple[str, ...] = ()


def plan_columns(total: str) -> dict[str, str]:
    """Names of the plan fuels after staging."""
    names = {
        "natural_gas_mwh": "dogalgaz", "wind_mwh": "ruzgar", "lignite_mwh": "linyit", "hard_coal_mwh": "tasKomur", "imported_coal_mwh": "ithalKomur",
        "fueloil_mwh": "fuelOil", "geothermal_mwh": "jeotermal", "dam_hydro_mwh": "barajli", "naphtha_mwh": "nafta", "biomass_mwh": "biokutle",
        "river_hydro_mwh": "akarsu", "solar_mwh": "gunes", "other_mwh": "diger",
    }
    return {total: "toplam", **names}


#: Column names on both sides.
GENERATION = {
    "total_generation_mwh": "total", "gas_generation_mwh": "naturalGas", "dam_generation_mwh": "dammedHydro", "lignite_generation_mwh": "lignite",
    "river_generation_mwh": "river", "imported_coal_generation_mwh": "importCoal", "wind_generation_mwh": "wind", "solar_generation_mwh": "sun",
    "fueloil_generation_mwh": "fueloil", "geothermal_generation_mwh": "geothermal", "asphaltite_coal_generation_mwh": "asphaltiteCoal",
    "black_coal_generation_mwh": "blackCoal", "biomass_generation_mwh": "biomass", "naphtha_generation_mwh": "naphta", "lng_generation_mwh": "lng",
    "import_export_mwh": "importExport", "waste_heat_generation_mwh": "wasteheat",
}
CAPACITY = {
    "total_aic_mwh": "toplam", "gas_aic_mwh": "dogalgaz", "wind_aic_mwh": "ruzgar", "lignite_aic_mwh": "linyit", "hard_coal_aic_mwh": "tasKomur",
    "imported_coal_aic_mwh": "ithalKomur", "fueloil_aic_mwh": "fuelOil", "geothermal_aic_mwh": "jeotermal", "dam_aic_mwh": "barajli",
    "naphtha_aic_mwh": "nafta", "biomass_aic_mwh": "biokutle", "river_aic_mwh": "akarsu", "solar_aic_mwh": "gunes",
}
UNLICENSED = {"total_unlicensed_mwh": "toplam", "wind_unlicensed_mwh": "ruzgar", "solar_unlicensed_mwh": "gunes", "biomass_unlicensed_mwh": "biyokutle", "biogas_unlicensed_mwh": "biyogaz", "canal_unlicensed_mwh": "kanalTipi", "other_unlicensed_mwh": "diger"}


def _order(side: str) -> dict[str, str]:
    return {f"{side}_regulation_{b.lower()}_mwh": f"{side}Regulation{b}Coded" for b in ("Zero", "One", "Two")} | {f"{side}_regulation_delivered_mwh": f"{side}RegulationDelivered", "net_mwh": "net"}


MODELS: dict[str, Model] = {
    "pricing": Model("pricing", {"ptf_try": "price", "ptf_usd": "priceUsd", "ptf_eur": "priceEur"}),
    "interim_mcp": Model("interim_mcp", {"interim_ptf_try": "marketTradePrice"}),
    "smf": Model("smf", {"smf_try": "systemMarginalPrice"}),
    "generation": Model("generation", GENERATION, clock="hour", latest=None),
    "unlicensed_generation": Model("unlicensed", UNLICENSED, clock="time", latest=None),
    "load_estimation": Model("load_estimation", {"forecasted_load_mwh": "lep"}, clock="time"),
    "load_vs_actual": Model("consumption", {"actual_consumption": "consumption"}, clock="time", day="utc"),
    "res_forecast": Model("res_forecast", {"forecasted_res_mwh": "forecast", "actual_res_generation_mwh": "generation"}, fold="avg"),
    "aic": Model("aic", CAPACITY),
    "dpp": Model("dpp", plan_columns("total_planned_mwh"), clock="time", latest=None),
    "sbfgp": Model("sbfgp", plan_columns("total_kgup_mwh"), clock="time", fold="none"),
    "kgup_bulk_by_org": Model("kgup_bulk_by_org", {"org_id": "orgId", "uevcb_id": "uevcbId", "uevcb_name": "uevcbName", **plan_columns("total_kgup_mwh")}, key=[*HOUR, "org_id", "uevcb_id"], clock="time", types={"org_id": "long", "uevcb_id": "long", "uevcb_name": "string"}),
    "dam_clearing": Model("dam_clearing", {"matched_bids_mwh": "matchedBids", "matched_offers_mwh": "matchedOffers"}),
    "dam_clearing_by_org": Model("dam_clearing_by_org", {"organization_id": "organizationId", "organization_name": "organizationName", "matched_bids_mwh": "matchedBids", "matched_offers_mwh": "matchedOffers"}, key=[*HOUR, "organization_id"], types={"organization_id": "long", "organization_name": "string"}),
    "order_up": Model("order_up", _order("up"), clock="hour", fold="sum"),
    "order_down": Model("order_down", _order("down"), clock="hour", fold="sum"),
    "system_direction": Model("system_direction", {"system_direction": "systemDirection"}, types={"system_direction": "string"}),
    "imbalance": Model("imbalance", {"total_generation_mwh": "generationTotal", "total_consumption_mwh": "consumption", "net_imbalance_mwh": "imbalanceQuantity"}),
    "price_ind_bid": Model("price_ind_bid", {"price_independent_bid_mwh": "bidVolume"}, clock="hour"),
    "supply_demand_curve": Model("supply_demand", {"bid_offer_price_try": "price", "cumulative_supply_mwh": "supply", "cumulative_demand_mwh": "demand"}, key=[*HOUR, "bid_offer_price_try"]),
    "idm_transactions": Model("idm_transactions", {"id": "id", "contract_name": "contractName", "price_try": "price", "quantity_mwh": "quantity"}, key=["id"], clock="hour", types={"id": "string", "contract_name": "string"}),
    "outages": Model("outages", {"id": "id", "start_time": "caseStartDate", "end_time": "caseEndDate", "company_name": "orgName", "plant_name": "powerPlantName", "installed_capacity_mwh": "operatorPower", "outage_capacity_mwh": "capacityAtCaseTime", "outage_reason": "reason"}, key=["id"], day="start", types={"id": "string", "start_time": "timestamp", "end_time": "timestamp", "company_name": "string", "plant_name": "string", "outage_reason": "string"}, latest="caseStartDate"),
    "dams": Model("dams", {"dam_id": "damId", "basin_name": "basinName", "dam_name": "damName", "active_volume": "activeVolume"}, key=["date", "dam_id"], day="day", types={"dam_id": "long", "basin_name": "string", "dam_name": "string"}),
    "weather": Model("weather", {"city_name": "city", "temperature_celsius": "temperature_2m", "wind_speed_kmh": "wind_speed_10m", "shortwave_radiation": "shortwave_radiation", "relative_humidity": "relative_humidity_2m"}, key=[*HOUR, "city_name"], types={"city_name": "string"}, fold="none", not_null=("date",)),
    "fx_rates": Model("fx_rates", {"date": "date", "usdtry": "usdtry", "is_ffilled": "is_ffilled"}, key=["date"], day="none", types={"date": "date", "is_ffilled": "boolean"}, fold="none"),
    "participants": Model("participants", {"organization_id": "id", "organization_name": "orgName", "organization_code": "orgCode", "eic_code": "eicCode", "legal_status": "legalStatus"}, key=["organization_id"], day="none", types={"organization_id": "long", "organization_name": "string", "organization_code": "string", "eic_code": "string", "legal_status": "string"}, latest=None),
}


def time_columns(model: Model, at: Callable[[str], Column] = F.col) -> dict[str, Column]:
    """date and hour of a silver row by the model's rule; ``at`` finds the silver columns."""
    if model.day == "none":
        return {}
    if model.day == "start":
        return {"date": F.to_date(at("caseStartDate"))}
    if model.day == "day":
        return {"date": local_date(at("date"))}
    date = F.to_date(at("date")) if model.day == "utc" else local_date(at("date"))
    return {"date": date, "hour": text_hour(at(model.clock)) if model.clock else local_hour(at("date"))}


def normalised_direction(label: Column) -> Column:
    out = F
    for said, name in DIRECTION_LABELS.items():
        out = out.when(label == said, F.lit(name))
    return out.otherwise(label)


def typed_columns(model: Model, at: Callable[[str], Column] = F.col) -> dict[str, Column]:
    typed = {new: at(old).try_cast(model.types.get(new, "double")) for new, old in model.columns.items()}
    if "system_direction" in typed:
        typed["system_direction"] = normalised_direction(typed["system_direction"])
    return typed


def stage(model: Model, silver: DataFrame, since=None) -> DataFrame:
    """Typed rows, one per key. ``since`` keeps rows from a date on (an incremental run)."""
    times, typed = time_columns(model), typed_columns(model)
    # Rows that tie on the time are told apart by the record hash, so reruns keep the same one.
    order = [F.col("_latest").desc()] if model.latest else []
    hashed = "_record_hash" in silver.columns
    rows = silver.select(
        *[c.alias(n) for n, c in {**times, **typed}.items()],
        *([F.col(model.latest).alias("_latest")] if model.latest and model.fold is None else []),
        *([F.col("_record_hash")] if hashed and model.fold is None else []),
    )
    if since is not None:
        rows = rows.where(F.col("date") >= F.lit(since))
    for c in model.not_null:
        rows = rows.where(F.col(c).isNotNull())
    if model.fold == "none":
        return rows
    if model.fold:
        fold = F.avg if model.fold == "avg" else F.sum
        return rows.groupBy(*model.key).agg(*[fold(c).alias(c) for c in typed if c not in model.key])
    return keep_one(rows, model.key, *order, *([F.col("_record_hash").desc()] if hashed else [])).drop("_latest", "_record_hash")


class Lake:
    """Staged tables by name over silver tables; each is planned once."""

    def __init__(self, silver: Silver):
        self.silver = silver
        self._staged: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._staged:
            model = MODELS[name]
            self._staged[name] = stage(model, self.silver[model.source])
        return self._staged[name]


def price_spread(lake: Lake) -> DataFrame:
    return lake["pricing"].select(*HOUR, "ptf_try").join(lake["smf"], HOUR, "left").withColumn("price_spread_try", F.col("ptf_try") - F.col("smf_try"))


def outages_daily(outages: DataFrame, as_of) -> DataFrame:
    """A row for each day on which an outage is active, up to ``as_of``; spans that end before they start are dropped."""
    last = F.least(F.to_date("end_time"), F.lit(as_of).cast("date"))
    whole = F.to_date("end_time") >= F.col("date")
    days = F.when(whole & (last >= F.col("date")), F.sequence(F.col("date"), last))
    spans = outages.where("date IS NOT NULL").withColumn("active_date", F.explode(days))
    return spans.select("id", "company_name", "plant_name", "installed_capacity_mwh", "outage_capacity_mwh", "outage_reason", F.col("date").alias("start_date"), F.to_date("end_time").alias("end_date"), "active_date")
