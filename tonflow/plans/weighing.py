"""Weighbridge transactions: raw rows to conformed haulage trips."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tonflow.functions import codes, numbers, text, times
from tonflow.operators.tables import surrogate_key
from tonflow.operators.windows import first_per_key
from tonflow.settings import DEFAULTS, Settings
from tonflow.sources.increments import with_columns_of

# --- Fixed values -----------------------------------------------------------------
# Source columns kept, by what they hold.
TEXT_COLUMNS = (
    "id", "truck", "driver", "client", "material", "hauling", "coal", "code",
    "data_source", "location_in", "location_closing", "last_rom_name", "last_port_name",
    "hauling_contractor", "truck_type", "status_trx_wim", "doc", "flag_line",
    "adjustment_result", "transaction_validation", "anomaly_message_in",
    "anomaly_message_create", "anomaly_message_out", "rfid", "rfid_wim",
)
NUMBER_COLUMNS = (
    "gross", "netto", "tare", "netto_ucan", "netto_ori", "total_gandar", "average_speed",
    "route_distance",
)
TIME_COLUMNS = (
    "timestamp_gross_local", "timestamp_gross_utc", "timestamp_in_local",
    "timestamp_in_utc", "timestamp_out_local", "timestamp_out_utc", "last_rom_date_time",
    "last_hauling_date_time", "last_port_date_time", "last_km13_date_time", "created_date",
)
MATERIAL_PARTS = ("block", "seam", "quality", "product")
SYSTEM = "WIM_UCAN"
MANUAL = "MANUAL"
ADJUSTED = ("Adjust", "Reject")
# --- end of fixed values ------------------------------------------------------------


def weighing_bronze(raw: DataFrame, origin: str, settings: Settings = DEFAULTS) -> DataFrame:
    """Known columns only, typed tolerantly, UTC times filled from local ones.

    Ids stay text: an 18-digit id does not survive a double.
    """
    rows = with_columns_of(raw, [*TEXT_COLUMNS, *NUMBER_COLUMNS, *TIME_COLUMNS])

    def utc_or_local(kind: str):
        local = times.to_utc(f"timestamp_{kind}_local", settings.timezone)
        return F.coalesce(F.col(f"timestamp_{kind}_utc"), local)

    typed = rows.select(
        *[text.present(c).alias(c) for c in TEXT_COLUMNS],
        *[F.col(c).cast("string").try_cast("double").alias(c) for c in NUMBER_COLUMNS],
        *[F.col(c).cast("string").try_cast("timestamp").alias(c) for c in TIME_COLUMNS],
    )
    return typed.withColumns(
        {
            "timestamp_gross_utc": utc_or_local("gross"),
            "timestamp_out_utc": utc_or_local("out"),
            "_ingested_at": F.current_timestamp(),
            "_source_origin": F.lit(origin),
            "_source_system": F.lit(SYSTEM),
        }
    )


def hauling_silver(bronze: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """One row per weighed trip with conformed codes, tons, cycle times and flags.

    A truck cannot be weighed twice in one second, so (truck, second) identifies a trip;
    of several such rows the one with the smallest id stays.  Rows without a weighing time
    have no such identity and all stay, told apart by their id.
    """
    tz = settings.timezone
    weighed = F.col("timestamp_gross_utc")
    truck = codes.upper_trim("truck")
    timed = surrogate_key(truck, weighed.cast("string"))
    untimed = surrogate_key(truck, F.lit("no-time"), F.col("id"))

    trips = bronze.withColumns(
        {
            "trip_id": F.when(weighed.isNotNull(), timed).otherwise(untimed),
            "wim_id_src": F.col("id"),
            "truck": truck,
            "client": codes.upper_trim("client"),
            "rom_code": codes.rom_code("last_rom_name"),
            "dest_code": codes.destination_code("last_port_name"),
            "contractor_code": F.coalesce(
                codes.upper_trim("hauling_contractor"),
                codes.upper_trim("code"),
                codes.truck_prefix("truck"),
            ),
            "netto_ton": numbers.kg_to_ton("netto", settings.kg_per_ton),
            "netto_ucan_ton": numbers.kg_to_ton("netto_ucan", settings.kg_per_ton),
            "weigh_ts_utc": weighed,
            "rom_exit_ts_utc": times.to_utc("last_rom_date_time", tz),
            "hauling_start_ts_utc": times.to_utc("last_hauling_date_time", tz),
            "port_arrival_ts_utc": times.to_utc("last_port_date_time", tz),
        }
    )
    trips = first_per_key(trips, ["trip_id"], [F.asc_nulls_last("wim_id_src")])
    trips = times.with_calendar(trips, "weigh_ts_utc", settings)

    netto = F.col("netto_ton")
    return trips.select(
        "trip_id", "wim_id_src", "truck", "truck_type", "driver", "contractor_code",
        codes.contractor_name("contractor_code", settings.contractors).alias("contractor_name"),
        "client", "rom_code", "dest_code",
        F.col("hauling").alias("route_code"),
        codes.flow_path("dest_code").alias("flow_path"),
        F.col("material").alias("material_code"),
        *text.code_parts("material", MATERIAL_PARTS, "material_"),
        F.col("coal").alias("coal_type"),
        numbers.kg_to_ton("gross", settings.kg_per_ton).alias("gross_ton"),
        numbers.kg_to_ton("tare", settings.kg_per_ton).alias("tare_ton"),
        "netto_ton", "netto_ucan_ton",
        F.round(netto - F.col("netto_ucan_ton"), 3).alias("netto_delta_wim_ucan_ton"),
        "weigh_ts_utc", "rom_exit_ts_utc", "hauling_start_ts_utc", "port_arrival_ts_utc",
        F.col("timestamp_out_utc").alias("gate_out_ts_utc"),
        times.signed_minutes("weigh_ts_utc", "rom_exit_ts_utc").alias("rom_to_weigh_min"),
        times.signed_minutes("port_arrival_ts_utc", "weigh_ts_utc").alias("weigh_to_port_min"),
        times.signed_minutes("port_arrival_ts_utc", "rom_exit_ts_utc").alias("rom_to_port_min"),
        "ts_local", "date_local", "hour_local", "production_date", "shift", "week_start", "month",
        "route_distance", "average_speed", "total_gandar", "data_source", "location_in",
        "location_closing", "doc", "status_trx_wim", "adjustment_result",
        ((netto < settings.payload_min_ton) | (netto > settings.payload_max_ton)).alias(
            "is_payload_anomaly"
        ),
        F.col("anomaly_message_in").isNotNull().alias("has_wim_anomaly_msg"),
        (F.col("status_trx_wim") == MANUAL).alias("is_manual_weigh"),
        F.col("adjustment_result").isin(*ADJUSTED).alias("is_adjusted"),
        (F.col("rom_code") == codes.UNKNOWN).alias("is_rom_unknown"),
        (F.col("dest_code") == codes.UNKNOWN).alias("is_dest_unknown"),
        "_source_system", "_ingested_at",
    )


def hauling_summary(trips: DataFrame) -> DataFrame:
    """Trips, tons and payload by path and loading point."""
    return (
        trips.groupBy("flow_path", "rom_code")
        .agg(
            F.count(F.lit(1)).alias("trips"),
            numbers.rsum("netto_ton", 1).alias("netto_ton"),
            numbers.ravg("netto_ton", 2).alias("avg_payload_ton"),
        )
        .orderBy(F.desc("netto_ton"), "flow_path", "rom_code")
    )
