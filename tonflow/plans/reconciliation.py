"""Trip reconciliation: each weighing with its loading, dumping and stockpile entry."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tonflow.functions import codes, numbers, times
from tonflow.operators.ordered import Leg, match_nearest
from tonflow.settings import DEFAULTS, Settings

TRIP_COLUMNS = (
    "trip_id", "truck", "contractor_code", "contractor_name", "client", "rom_code",
    "dest_code", "flow_path", "material_code", "coal_type", "netto_ton", "weigh_ts_utc",
    "rom_exit_ts_utc", "port_arrival_ts_utc", "rom_to_port_min", "production_date", "shift",
    "week_start", "month", "is_payload_anomaly", "is_manual_weigh",
)


def reconcile_trips(
    hauling: DataFrame,
    loading: DataFrame,
    dumping: DataFrame,
    ledger: DataFrame,
    settings: Settings = DEFAULTS,
) -> DataFrame:
    """Every weighed trip, matched or not, with the differences between the scales.

    Loading is the nearest before the weighing, dumping and stockpile entry the first
    after it, each of the same truck and within the matching window.  All three are found
    in one shuffle.  Stockpile entries are only looked for when the trip goes there.
    """
    legs = [
        Leg(
            "loaded", loading, "rom_exit_ts_utc", "backward", "event_id",
            ["event_id", "rom_code", "rom_exit_ts_utc", "tonase_ton", "rom_ticket_no",
             "loader_type", "material_code"],
        ),
        Leg(
            "dumped", dumping, "dump_ts_utc", "forward", "event_id",
            ["event_id", "cp_code", "dump_ts_utc", "tonase_ton", "source_leg"],
        ),
        Leg(
            "stocked", ledger.where("movement = 'IN'"), "txn_ts_utc", "forward", "stock_txn_id",
            ["stock_txn_id", "txn_ts_utc", "qty_ton"],
            when=F.col("flow_path") == "VIA_STOCKPILE",
        ),
    ]
    matched = match_nearest(
        hauling.select(*TRIP_COLUMNS), ["truck"], "weigh_ts_utc", legs,
        settings.match_hours, settings.match_slot_minutes,
    )
    flat = matched.select(
        *TRIP_COLUMNS,
        F.col("loaded.event_id").alias("rom_event_id"),
        F.col("loaded.rom_code").alias("rom_code_urise"),
        F.col("loaded.rom_exit_ts_utc").alias("rom_event_ts_utc"),
        F.col("loaded.tonase_ton").alias("rom_ton_urise"),
        F.col("loaded.rom_ticket_no").alias("rom_ticket_no"),
        F.col("loaded.loader_type").alias("loader_type"),
        F.col("loaded.material_code").alias("rom_material_code"),
        F.col("dumped.event_id").alias("cp_event_id"),
        F.col("dumped.cp_code").alias("cp_code"),
        F.col("dumped.dump_ts_utc").alias("cp_dump_ts_utc"),
        F.col("dumped.tonase_ton").alias("cp_ton_urise"),
        F.col("dumped.source_leg").alias("cp_source_leg"),
        F.col("stocked.stock_txn_id").alias("stock_in_txn_id"),
        F.col("stocked.txn_ts_utc").alias("stock_in_ts_utc"),
        F.col("stocked.qty_ton").alias("stock_in_ton"),
    )
    at_rom, at_cp = F.col("rom_event_id").isNotNull(), F.col("cp_event_id").isNotNull()
    loaded, weighed, dumped = F.col("rom_ton_urise"), F.col("netto_ton"), F.col("cp_ton_urise")
    return flat.withColumns(
        {
            "delta_rom_vs_wim_ton": F.round(loaded - weighed, 3),
            "delta_wim_vs_cp_ton": F.round(weighed - dumped, 3),
            "delta_rom_vs_cp_ton": F.round(loaded - dumped, 3),
            "loss_pct_wim_vs_cp": numbers.percent(weighed - dumped, weighed),
            "rom_code_mismatch": F.coalesce(F.col("rom_code_urise") != F.col("rom_code"), F.lit(False)),
            "is_matched_rom": at_rom,
            "is_matched_cp": at_cp,
            "is_matched_stock": F.col("stock_in_txn_id").isNotNull(),
            "match_completeness": at_rom.cast("int") + at_cp.cast("int"),
            "trip_status": codes.cases(
                [(at_rom & at_cp, "FULL_TRACE"), (at_cp, "CP_ONLY"), (at_rom, "ROM_ONLY")],
                "WEIGH_ONLY",
            ),
            "cycle_time_min": times.signed_minutes("cp_dump_ts_utc", "rom_event_ts_utc"),
        }
    )


def trace_summary(trips: DataFrame) -> DataFrame:
    """Per day, shift and contractor, what the marts need of the matched trips.

    The row-level table is read once; contractor losses and daily trace rates both roll up
    from these sums.
    """
    matched = F.col("is_matched_cp")

    def when_matched(c: str):
        return F.when(matched, F.col(c))

    return trips.groupBy("production_date", "shift", "contractor_code").agg(
        F.count(F.lit(1)).alias("trips"),
        F.count_if(matched).alias("traced_trips"),
        F.count_if("is_matched_rom").alias("rom_traced_trips"),
        F.sum(when_matched("loss_pct_wim_vs_cp")).alias("loss_pct_sum"),
        F.count(when_matched("loss_pct_wim_vs_cp")).alias("loss_pct_n"),
        F.sum(when_matched("delta_wim_vs_cp_ton")).alias("loss_ton"),
    )


def contractor_losses(summary: DataFrame) -> DataFrame:
    return summary.where("traced_trips > 0").select(
        "production_date", "shift", "contractor_code",
        numbers.steady(F.try_divide("loss_pct_sum", "loss_pct_n"), 2).alias("avg_loss_pct"),
        numbers.steady("loss_ton", 3).alias("total_loss_ton"),
        "traced_trips",
    )


def daily_trace(summary: DataFrame) -> DataFrame:
    n = F.sum("trips")
    return summary.groupBy("production_date").agg(
        numbers.steady(F.sum("traced_trips") * 100.0 / n, 1).alias("cp_trace_rate_pct"),
        numbers.steady(F.sum("rom_traced_trips") * 100.0 / n, 1).alias("rom_trace_rate_pct"),
        numbers.steady(F.sum("loss_ton"), 3).alias("traced_loss_ton"),
    )


def status_summary(trips: DataFrame) -> DataFrame:
    return (
        trips.groupBy("trip_status")
        .agg(
            F.count(F.lit(1)).alias("trips"),
            numbers.rsum("netto_ton", 1).alias("netto_ton"),
            numbers.ravg("loss_pct_wim_vs_cp", 2).alias("avg_loss_pct"),
        )
        .orderBy(F.desc("trips"), "trip_status")
    )
