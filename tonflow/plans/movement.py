"""Truck movement through plant queues: cleaned rows, summaries, exceptions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tonflow.functions import codes, numbers, text, times
from tonflow.functions.text import column_or_null

# --- Fixed values -----------------------------------------------------------------
LONG_FIELDS = (
    "assignment_id", "truck_id", "lane_id", "lane_id_sb", "cp_queue_id", "round_robin_cp",
)
BOOLEAN_FIELDS = ("back_to_queue", "is_anomaly", "is_anomaly_queue_lane", "is_northstockpile_2")
TIME_FIELDS = (
    "created_at", "auditupdate", "entrance_time", "exit_time", "exit_cp_time",
    "assignment_time", "rfid_queue_time", "exit_antrian_cp_time", "entrance_acp_time",
    "rfid_cp_time", "geofence_cp_time", "entrance_cop_time", "rfid_cp_out_time",
    "sicantik_time",
)
# Signals tried in turn for entering and leaving, and for the time of the transaction.
ENTERED = ("entrance_time", "entrance_acp_time", "rfid_cp_time", "geofence_cp_time", "assignment_time")
LEFT = ("exit_cp_time", "exit_time", "rfid_cp_out_time")
VALID = "valid"
COMPLETED = "COMPLETED"
# --- end of fixed values ------------------------------------------------------------


def movement_silver(raw: DataFrame) -> DataFrame:
    """Parsed fields, fallback entry and exit times, status, durations, quality status.

    Fields the source lacks are treated as missing values.
    """
    clean = text.blank_dump_markers(raw)
    typed: dict = {f"{c}_value": numbers.to_long(column_or_null(clean, c)) for c in LONG_FIELDS}
    typed["tonnage_value"] = numbers.to_double(column_or_null(clean, "tonnage"))
    typed |= {f"{c}_bool": text.to_boolean(column_or_null(clean, c)) for c in BOOLEAN_FIELDS}
    for c in TIME_FIELDS:
        typed[c if c.endswith("_ts") else f"{c}_ts"] = times.parse_any(column_or_null(clean, c))
    rows = clean.withColumns(typed).withColumns(
        {
            "vehicle_in_time_ts": F.coalesce(*[f"{c}_ts" for c in ENTERED]),
            "vehicle_out_time_ts": F.coalesce(*[f"{c}_ts" for c in LEFT]),
        }
    )
    entered, left = F.col("vehicle_in_time_ts").isNotNull(), F.col("vehicle_out_time_ts").isNotNull()
    rows = rows.withColumns(
        {
            "transaction_ts": F.coalesce(
                "created_at_ts", "vehicle_in_time_ts", "assignment_time_ts", "auditupdate_ts"
            ),
            "vehicle_movement_status": codes.cases(
                [(entered & left, "IN_OUT_COMPLETED"), (entered, "IN_NOT_OUT"), (left, "OUT_WITHOUT_IN")],
                codes.UNKNOWN,
            ),
            "queue_duration_minutes": times.elapsed_minutes(
                "exit_antrian_cp_time_ts", "rfid_queue_time_ts"
            ),
            "cp_area_duration_minutes": times.elapsed_minutes(
                "vehicle_out_time_ts", "vehicle_in_time_ts"
            ),
            "cp_process_duration_minutes": times.elapsed_minutes(
                "rfid_cp_out_time_ts", F.coalesce("rfid_cp_time_ts", "geofence_cp_time_ts")
            ),
            "audit_latency_minutes": times.elapsed_minutes("auditupdate_ts", "created_at_ts"),
        }
    )
    problems = [
        (F.col("assignment_id_value").isNull(), "missing_assignment_id"),
        (column_or_null(rows, "queue_name").isNull(), "missing_cp"),
        (F.col("truck_id_value").isNull(), "missing_truck_id"),
        (~entered, "missing_vehicle_in_time"),
        (column_or_null(rows, "status").isNull(), "missing_status"),
    ]
    return rows.withColumns(
        {
            "transaction_date": F.to_date("transaction_ts"),
            "transaction_hour": F.hour("transaction_ts"),
            "data_quality_status": codes.cases(problems, VALID),
            "silver_processed_at": F.current_timestamp(),
        }
    )


MEASURES = {
    "total_transaction": lambda: F.count_distinct("assignment_id_value"),
    "total_vehicle": lambda: F.count_distinct("truck_id_value"),
    "vehicle_in": lambda: F.count("vehicle_in_time_ts"),
    "vehicle_out": lambda: F.count("vehicle_out_time_ts"),
    "completed_transaction": lambda: F.count_if(F.col("status") == COMPLETED),
    "total_tonnage": lambda: numbers.rsum("tonnage_value", 6),
    "avg_tonnage_per_vehicle": lambda: numbers.ravg("tonnage_value", 6),
    "avg_queue_duration_minutes": lambda: numbers.ravg("queue_duration_minutes", 6),
    "avg_cp_area_duration_minutes": lambda: numbers.ravg("cp_area_duration_minutes", 6),
    "avg_cp_process_duration_minutes": lambda: numbers.ravg("cp_process_duration_minutes", 6),
    "anomaly_count": lambda: F.count_if("is_anomaly_bool"),
    "anomaly_queue_lane_count": lambda: F.count_if("is_anomaly_queue_lane_bool"),
    "data_quality_issue_count": lambda: F.count_if(F.col("data_quality_status") != VALID),
    "total_rows": lambda: F.count(F.lit(1)),
}

DISTINCT = ("total_transaction", "total_vehicle")

DAILY = ("transaction_date", "queue_name", "port", "truck_type")
HOURLY = ("transaction_date", "transaction_hour", "queue_name", "port")
LANE = ("transaction_date", "queue_name", "lane_id_value", "lane_sb")


def vehicle_summary(
    movements: DataFrame,
    keys: Sequence[str] = (),
    measures: Sequence[str] = tuple(MEASURES),
    names: dict | None = None,
) -> DataFrame:
    """Chosen measures by chosen keys (none for overall KPIs); ``names`` renames measures.

    Distinct counts are made apart from the other measures, and both meet as one row per group.
    In one aggregation Spark keeps the sums of all other measures beside every distinct value.
    """
    names = names or {}
    chosen = [MEASURES[m]().alias(names.get(m, m)) for m in measures]
    parts = [[c for m, c in zip(measures, chosen, strict=True) if (m in DISTINCT) is d] for d in (True, False)]
    tables = [movements.groupBy(*keys).agg(*part) for part in parts if part]
    if len(tables) < 2:
        return movements.groupBy(*keys).agg(*chosen)
    both = tables[0].unionByName(tables[1], allowMissingColumns=True)
    return both.groupBy(*keys).agg(*[F.max(n).alias(n) for n in (names.get(m, m) for m in measures)])


def daily_summary(movements: DataFrame) -> DataFrame:
    keep = [m for m in MEASURES if m != "total_rows"]
    names = {"vehicle_in": "total_vehicle_in", "vehicle_out": "total_vehicle_out"}
    return vehicle_summary(movements, DAILY, keep, names)


def hourly_summary(movements: DataFrame) -> DataFrame:
    keep = [
        "total_transaction", "total_vehicle", "vehicle_in", "vehicle_out", "total_tonnage",
        "avg_tonnage_per_vehicle", "avg_queue_duration_minutes", "avg_cp_area_duration_minutes",
        "avg_cp_process_duration_minutes",
    ]
    return vehicle_summary(movements, HOURLY, keep)


def lane_summary(movements: DataFrame) -> DataFrame:
    keep = [
        "total_transaction", "total_vehicle", "vehicle_in", "vehicle_out", "total_tonnage",
        "avg_tonnage_per_vehicle", "avg_cp_process_duration_minutes",
        "avg_cp_area_duration_minutes", "anomaly_count", "data_quality_issue_count",
    ]
    return vehicle_summary(movements, LANE, keep)


def hourly_trend(movements: DataFrame) -> DataFrame:
    keys = ["transaction_date", "transaction_hour"]
    return vehicle_summary(movements, keys, ["vehicle_in", "vehicle_out", "total_tonnage"]).orderBy(*keys)


EXCEPTION_COLUMNS = (
    "transaction_date", "transaction_ts", "created_at_ts", "queue_name", "port",
    "lane_id_value", "lane_sb", "truck_id_value", "nomor_lambung", "truck_type", "status",
    "completed_by", "assigned_by", "vehicle_movement_status", "tonnage_value", "sk_number",
    "data_quality_status", "is_anomaly_bool", "is_anomaly_queue_lane_bool",
    "tonnage_recovery_status", "queue_duration_minutes", "cp_area_duration_minutes",
    "cp_process_duration_minutes", "audit_latency_minutes",
)


def exceptions(movements: DataFrame) -> DataFrame:
    """Rows that need attention: quality problem, incomplete movement or flagged anomaly."""
    suspicious = (
        (F.col("data_quality_status") != VALID)
        | (F.col("vehicle_movement_status") != "IN_OUT_COMPLETED")
        | F.col("is_anomaly_bool")
        | F.col("is_anomaly_queue_lane_bool")
    )
    # A filter would move below the parsing and repeat it for every mention; it stays above what depends
    # on the partition's number.
    marked = movements.withColumn("_suspicious", F.when(F.spark_partition_id() >= 0, suspicious))
    return marked.where("_suspicious").select(
        *[column_or_null(movements, c).alias(c) for c in EXCEPTION_COLUMNS]
    )
