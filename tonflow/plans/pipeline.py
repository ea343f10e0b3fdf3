"""The whole batch run: raw tables to marts, checked before anything is published."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame

from tonflow.operators.quality import gate
from tonflow.plans import checks, funnel, marts, production, reconciliation, stock, suggestions
from tonflow.plans import visits as visit_plans
from tonflow.plans import weighing
from tonflow.settings import DEFAULTS, Settings
from tonflow.sources.session import cut_lineage
from tonflow.sources.tables import estimated_shipment

Keep = Callable[[DataFrame], DataFrame]


@dataclass
class Silver:
    hauling: DataFrame
    visits: DataFrame
    ledger: DataFrame
    loading: DataFrame
    dumping: DataFrame


def build_silver(
    weighings: DataFrame,
    visits: DataFrame,
    movements: DataFrame,
    settings: Settings = DEFAULTS,
    origin: str = "TABLE",
    keep: Keep | None = None,
) -> Silver:
    """Conformed tables from raw ones.  ``keep`` stores each and gives it back, so that the
    marts do not repeat the cleaning (write a table, or :func:`cut_lineage`)."""
    keep = keep or (lambda df: df)
    hauling = keep(weighing.hauling_silver(weighing.weighing_bronze(weighings, origin, settings), settings))
    seen = keep(visit_plans.visit_silver(visit_plans.visit_bronze(visits, origin), settings))
    ledger = keep(stock.stock_silver(stock.stock_bronze(movements, origin), settings))
    return Silver(
        hauling, seen, ledger, visit_plans.rom_loading(seen), visit_plans.plant_dumping(seen)
    )


def build_gold(
    silver: Silver,
    shipment: DataFrame | None = None,
    plant_output: DataFrame | None = None,
    settings: Settings = DEFAULTS,
    keep: Keep = cut_lineage,
) -> dict[str, DataFrame]:
    """All marts by name.  Row-level tables are reduced to days once; ``keep`` stores those
    small daily tables before they are joined with each other."""
    trips = reconciliation.reconcile_trips(
        silver.hauling, silver.loading, silver.dumping, silver.ledger, settings
    )
    trace = keep(reconciliation.trace_summary(trips))
    if shipment is None:
        shipment = estimated_shipment(funnel.daily_intake(silver.dumping), settings.recovery_factor)
    funnel_rows = keep(
        funnel.funnel(silver.loading, silver.hauling, silver.ledger, silver.dumping, shipment, settings)
    )
    gaps = funnel.stage_gaps(funnel_rows, settings)
    daily = keep(production.daily_production(silver.hauling, settings))
    outlook = production.shipment_outlook(daily, settings)
    contractors = keep(
        marts.contractor_daily(silver.hauling, reconciliation.contractor_losses(trace), settings)
    )
    roms = keep(marts.rom_daily(silver.hauling, silver.loading, settings))
    intake = keep(marts.plant_intake(silver.dumping, silver.hauling, plant_output, settings))
    balance = keep(stock.stock_balance(silver.ledger, intake, settings))
    anomalies = keep(marts.loss_anomalies(marts.loss_series(gaps, contractors, roms), settings))
    kpis = keep(
        marts.kpi_snapshot(
            funnel_rows,
            marts.daily_operations(silver.hauling),
            reconciliation.daily_trace(trace),
            stock.closing_stock(balance),
            marts.daily_anomalies(anomalies),
            outlook,
            settings,
        )
    )
    found = keep(
        suggestions.suggestion_candidates(
            contractors, anomalies, gaps, outlook, balance, intake, kpis, settings
        )
    )
    return {
        "trip_reconciliation": trips,
        "trace_summary": trace,
        "funnel_stage_daily": funnel_rows,
        "stage_reconciliation": gaps,
        "production_daily": daily,
        "production_timeseries": production.production_series(daily, settings),
        "contractor_daily": contractors,
        "rom_daily": roms,
        "cp_intake_daily": intake,
        "stockpile_balance_hourly": balance,
        "loss_anomaly": anomalies,
        "shipment_outlook": outlook,
        "kpi_snapshot": kpis,
        "suggestion_candidates": found,
        "suggestion_daily": suggestions.top_suggestions(found, settings=settings),
    }


def publish(
    silver: Silver,
    gold: dict[str, DataFrame],
    write: Callable[[str, DataFrame], object],
    settings: Settings = DEFAULTS,
) -> DataFrame:
    """Check first, then write: a failed blocking check leaves the published tables alone."""
    log = checks.production_checks(
        silver.hauling, silver.visits, silver.ledger, gold["trip_reconciliation"],
        gold["funnel_stage_daily"], gold["production_daily"], settings,
    )
    log = gate(cut_lineage(log))
    for name, table in gold.items():
        write(name, table)
    return log
