"""Truck visits to loading points, stockpile and plants (RFID gates and geofences)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tonflow.functions import codes, numbers, text, times
from tonflow.operators.windows import first_per_key
from tonflow.plans.weighing import MATERIAL_PARTS
from tonflow.settings import DEFAULTS, Settings
from tonflow.sources.increments import with_columns_of

# --- Fixed values -----------------------------------------------------------------
SYSTEM = "URISE"
TIME_COLUMNS = (
    "room_in", "room_out", "created_at", "updated_at", "validated_at", "deleted_at",
    "time_out_ucan",
)
TEXT_COLUMNS = (
    "no_lambung", "kontraktor", "master_location", "location", "location_out", "material",
    "sk", "alat_muat", "data_source", "rfid", "device_id", "is_anomaly", "is_deleted",
)
ENTRY_GATES = "(?i)GATE3"
EXIT_GATES = "(?i)GATE4|GATE5"
# --- end of fixed values ------------------------------------------------------------


def visit_bronze(raw: DataFrame, origin: str) -> DataFrame:
    """Markers blanked, times and numbers typed, lineage added; other columns pass through."""
    missing = [c for c in ("id", "tonase", *TEXT_COLUMNS, *TIME_COLUMNS) if c not in raw.columns]
    full = with_columns_of(raw, [*raw.columns, *missing])
    clean = text.blank_markers(full)
    typed = {c: times.parse_iso(c) for c in TIME_COLUMNS}
    return clean.withColumns(
        typed
        | {
            "id": F.col("id").try_cast("long"),
            "tonase": F.col("tonase").try_cast("double"),
            "_ingested_at": F.current_timestamp(),
            "_source_origin": F.lit(origin),
            "_source_system": F.lit(SYSTEM),
        }
    )


def visit_silver(bronze: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """One row per visit; the latest update of an id stays."""
    current = first_per_key(
        bronze.where("id IS NOT NULL"),
        ["id"],
        [F.desc_nulls_last("updated_at"), F.desc_nulls_last("room_in"), F.asc_nulls_last("tonase")],
    )
    visits = current.withColumns(
        {
            "truck": codes.upper_trim("no_lambung"),
            "node_code": codes.node_code("master_location"),
            "tonase_ton": numbers.kg_to_ton("tonase", settings.kg_per_ton),
        }
    )
    visits = visits.withColumn(
        "contractor_code", F.coalesce(codes.truck_prefix("truck"), F.lit(codes.UNKNOWN))
    )
    visits = times.with_calendar(visits, "room_in", settings)
    return visits.select(
        F.col("id").alias("event_id"),
        "truck", "contractor_code",
        F.coalesce(
            F.trim("kontraktor"), codes.contractor_name("contractor_code", settings.contractors)
        ).alias("contractor_name"),
        "node_code",
        codes.node_type("node_code").alias("node_type"),
        F.col("location").alias("gate_in"),
        F.col("location_out").alias("gate_out"),
        F.col("room_in").alias("time_in_utc"),
        F.col("room_out").alias("time_out_utc"),
        times.signed_minutes("room_out", "room_in").alias("dwell_minutes"),
        "tonase_ton",
        F.col("material").alias("material_code"),
        *text.code_parts("material", MATERIAL_PARTS, "material_"),
        F.col("sk").alias("rom_ticket_no"),
        F.col("alat_muat").alias("loader_type"),
        F.col("data_source").alias("capture_source"),
        "rfid", "device_id",
        "ts_local", "date_local", "hour_local", "production_date", "shift", "week_start", "month",
        F.col("contractor_code").isin(*settings.stockpile_fleets).alias("is_stockpile_fleet"),
        text.is_true_text("is_anomaly").alias("is_anomaly_flag"),
        text.is_true_text("is_deleted").alias("is_deleted_flag"),
        F.col("tonase_ton").isNotNull().alias("has_tonnage"),
        F.col("room_out").isNull().alias("is_open_visit"),
        "_source_system", "_ingested_at",
    )


def _at(visits: DataFrame, kind: str) -> DataFrame:
    return visits.where((F.col("node_type") == kind) & ~F.col("is_deleted_flag"))


def _left_at():
    return F.coalesce("time_out_utc", "time_in_utc")


def rom_loading(visits: DataFrame) -> DataFrame:
    """Loading at the mine; leaving time falls back to entering time."""
    return _at(visits, "ROM").withColumnRenamed("node_code", "rom_code").withColumn(
        "rom_exit_ts_utc", _left_at()
    )


def plant_dumping(visits: DataFrame) -> DataFrame:
    """Dumping at a crushing plant, with the leg the truck came on."""
    leg = F.when(F.col("is_stockpile_fleet"), "FROM_STOCKPILE").otherwise("FROM_ROM_DIRECT")
    return _at(visits, "CP").withColumnRenamed("node_code", "cp_code").withColumns(
        {"dump_ts_utc": _left_at(), "source_leg": leg}
    )


def stockpile_visits(visits: DataFrame) -> DataFrame:
    """Visits to the stockpile with the direction read off the gates passed."""
    enters = F.coalesce(F.col("gate_in").rlike(ENTRY_GATES), F.lit(False))
    leaves = F.coalesce(F.col("gate_out").rlike(EXIT_GATES), F.lit(False))
    return _at(visits, "STOCKPILE").withColumn(
        "direction", codes.cases([(enters, "IN"), (leaves, "OUT")], codes.UNKNOWN)
    )


def tonnage_coverage(visits: DataFrame) -> DataFrame:
    """How many visits to each kind of place carry a tonnage."""
    return (
        visits.where(F.col("node_type") != codes.UNRESOLVED)
        .groupBy("node_type")
        .agg(
            F.count(F.lit(1)).alias("events"),
            numbers.count_true("has_tonnage").alias("events_with_ton"),
            numbers.rate_of("has_tonnage").alias("coverage_pct"),
            numbers.rsum("tonase_ton", 1).alias("total_ton"),
        )
    )


def operational_rollup(visits: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """Hourly tonnage per place and contractor by operational day (raw visits in).

    Rows lacking any grouping value are left out.
    """
    start = settings.day_start_hour
    rows = visits.select(
        F.to_date(times.hours_back("room_in", start)).alias("op_date"),
        times.shifted_hour("room_in", start).alias("op_hour"),
        times.shifted_hour_start("room_in", start).alias("op_datetime"),
        F.to_date("room_in").alias("date"),
        F.hour("room_in").alias("hour"),
        times.shift_label("room_in", "DS", "NS", start).alias("shift"),
        "master_location", "kontraktor", "id", "no_lambung",
        numbers.number_or_zero("tonase").alias("tonase"),
    )
    keys = rows.columns[:8]
    return (
        rows.dropna(subset=keys)
        .groupBy(*keys)
        .agg(
            F.count("id").alias("jumlah_transaksi"),
            F.count_distinct("no_lambung").alias("jumlah_unit_aktif"),
            numbers.rsum("tonase", 6).alias("tonase"),
        )
        .orderBy("op_date", "op_hour", "master_location", "kontraktor")
    )


def stockpile_rollup(visits: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """In- and outbound counts and tonnage of the stockpile by day, shift and hour."""
    came = F.coalesce(F.trim("location"), F.lit(""))
    went = F.coalesce(F.trim("location_out"), F.lit(""))
    ton = numbers.number_or_zero("tonase")
    start = settings.day_start_hour
    rows = visits.select(
        F.to_date(times.hours_back("room_in", start)).alias("op_date"),
        times.shift_label("room_in", "DS", "NS", start).alias("shift"),
        F.hour("room_in").alias("hour"),
        (came.contains("IN") & (ton > 0)).alias("inbound"),
        (went.endswith("OUT") | came.contains("OUT")).alias("outbound"),
        ((came != "") & (went == "")).alias("inside"),
        ton.alias("ton"),
    )
    keys = ["op_date", "shift", "hour"]
    return (
        rows.dropna(subset=keys)
        .groupBy(*keys)
        .agg(
            F.count_if("inbound").alias("jumlah_inbound"),
            F.count_if("outbound").alias("jumlah_outbound"),
            F.count_if("inside").alias("jumlah_aktif_geofence"),
            numbers.rsum("ton", 6).alias("jumlah_tonase"),
            numbers.rsum(F.when(F.col("inbound"), F.col("ton")).otherwise(0.0), 6).alias("tonase_inbound"),
            numbers.rsum(F.when(F.col("outbound"), F.col("ton")).otherwise(0.0), 6).alias("tonase_outbound"),
        )
        .orderBy(*keys)
    )
