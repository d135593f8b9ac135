"""The registered market queries, by the ids of the operator inventory."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..functions.expressions import rounded
from ..sources.bindings import Silver
from . import marts, model_queries, more_queries, oracles, report_queries, source_queries, staging
from .oracles import AS_OF

Query = Callable[[SparkSession, str], DataFrame]


def lake_of(spark: SparkSession, sf_dir: str) -> staging.Lake:
    return staging.Lake(Silver(spark, sf_dir))


def _name(kind: str, plan: str) -> str:
    return f"{kind}_{plan}".replace("-", "")


def _mart(plan: Callable[[staging.Lake], DataFrame]) -> Query:
    return lambda spark, sf_dir: rounded(plan(lake_of(spark, sf_dir)))


def _queries() -> tuple[dict[str, Query], dict[str, str]]:
    queries: dict[str, Query] = {}
    twins: dict[str, str] = {}

    def add(name: str, query: Query, twin: str | None) -> None:
        queries[name] = query
        if twin:
            twins[name] = twin

    for key, plan in marts.MARTS.items():
        add(_name(key.replace("-", ""), plan.__name__) if key != "MA-5" else "MA5_dgp_company_analysis", _mart(plan), oracles.MART_TWINS.get(key))
    for key, plan in marts.DATED_MARTS.items():
        add(_name(key.replace("-", ""), plan.__name__), _mart(lambda lake, plan=plan: plan(lake, AS_OF)), oracles.MART_TWINS.get(key))
    add("MA29_smf_forecast_outlook", _mart(lambda lake: marts.smf_forecast_outlook(lake, marts.naive_predictions(lake))), oracles.MART_TWINS.get("MA-29"))
    for i, (name, key) in enumerate(STAGED.items(), 1):
        add(f"ST{i}_{name}", _mart(key), oracles.STAGED_TWINS.get(name))
    return queries, twins


def _staged(name: str) -> Callable[[staging.Lake], DataFrame]:
    return lambda lake: lake[name]


def _recent_trades(lake: staging.Lake) -> DataFrame:
    from pyspark.sql import functions as F

    return lake["idm_transactions"].where(F.col("date") >= F.date_sub(F.lit(AS_OF).cast("date"), 7))


#: Staged tables in the order of the inventory.
STAGED: dict[str, Callable[[staging.Lake], DataFrame]] = {
    **{n: _staged(n) for n in ("pricing", "interim_mcp", "smf", "generation", "unlicensed_generation", "load_estimation", "load_vs_actual", "res_forecast", "aic", "dpp", "sbfgp", "kgup_bulk_by_org", "dam_clearing", "dam_clearing_by_org", "order_up", "order_down", "system_direction", "imbalance", "price_ind_bid")},
    "price_spread": staging.price_spread,
    "supply_demand_curve": _staged("supply_demand_curve"),
    "idm_transactions_recent": _recent_trades,
    "idm_transactions": _staged("idm_transactions"),
    "outages": _staged("outages"),
    "outages_daily": lambda lake: staging.outages_daily(lake["outages"], AS_OF),
    **{n: _staged(n) for n in ("dams", "weather", "fx_rates", "participants")},
}

QUERIES, ORACLE_SQL = _queries()
for part in (report_queries, source_queries, model_queries, more_queries):
    QUERIES |= part.QUERIES
    ORACLE_SQL |= part.ORACLE_SQL
