"""The standard quality checks over the production tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tonflow.functions import codes
from tonflow.operators.quality import BLOCKING, WARNING, Check, check_log, percent_of_rows, repeated_rows, run_checks
from tonflow.plans.funnel import overflow_days
from tonflow.settings import DEFAULTS, Settings


def production_checks(
    hauling: DataFrame,
    visits: DataFrame,
    ledger: DataFrame,
    trips: DataFrame,
    funnel_rows: DataFrame,
    daily: DataFrame,
    settings: Settings = DEFAULTS,
) -> DataFrame:
    """Check log of a run: one aggregate per table instead of one job per check."""
    surplus = run_checks(
        repeated_rows(hauling, ["trip_id"]),
        [Check("unique_trip_id", "silver", "hauling", BLOCKING, F.max("surplus_rows"), 0)],
    )
    netto = F.col("netto_ton")
    weighing = run_checks(
        hauling,
        [
            Check("netto_positive", "silver", "hauling", BLOCKING, F.count_if(~F.coalesce(netto > 0, F.lit(False))), 0),
            Check("payload_in_range", "silver", "hauling", WARNING, percent_of_rows(F.col("is_payload_anomaly")), 2.0),
            Check("rom_resolved", "silver", "hauling", WARNING, percent_of_rows(F.col("is_rom_unknown")), 5.0),
        ],
    )
    nodes = run_checks(
        visits,
        [Check("node_resolved", "silver", "visits", WARNING, percent_of_rows(F.col("node_type") == codes.UNRESOLVED), 5.0)],
    )
    stock = run_checks(
        ledger,
        [Check("stock_qty_positive", "silver", "ledger", WARNING, percent_of_rows(F.col("is_zero_qty")), 10.0)],
    )
    traced = run_checks(
        trips,
        [Check("trip_trace_rate", "silver", "trips", WARNING, percent_of_rows(F.col("is_matched_cp")), 80.0, at_least=True)],
    )
    shape = run_checks(
        overflow_days(funnel_rows, settings=settings),
        [Check("funnel_monotonic", "gold", "funnel", BLOCKING, F.max("overflow_days"), 0)],
    )
    day = F.col("production_date")
    missing = F.datediff(F.max(day), F.min(day)) + 1 - F.count_distinct(day)
    days = run_checks(
        daily, [Check("no_missing_days", "gold", "daily", WARNING, missing, 0)]
    )
    return check_log(surplus, weighing, nodes, stock, traced, shape, days)
