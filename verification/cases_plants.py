"""Crushing plants and truck movement."""

from __future__ import annotations

from pyspark.sql import functions as F

from tonflow.operators.ordered import counter_delta, drop_repeats, previous_row, time_slot
from tonflow.operators.quality import distribution
from tonflow.plans import crushing, dashboards, marts, movement
from tonflow.sources.session import cut_lineage
from verification import inputs
from verification.cases_haulage import dumping, hauling
from verification.ctes import pct, rd
from verification.registry import case


def tonnage(spark, d):
    return crushing.tonnage_silver(inputs.totaliser_logs(spark, d))


def running(spark, d):
    return crushing.running_stats(crushing.status_silver(inputs.equipment_logs(spark, d)), "adjusted_date")


READING_COLUMNS = [
    "location", "timestamp_data_ts", "totalizer_today", "time_delta_seconds", "delta_volume", "tonnage_delta",
    "tonnage_total_today", "throughput_tph", "flow_mode", "linked_cp", "shift", "adjusted_date",
]


@case("tonnage_silver", f"SELECT {', '.join(READING_COLUMNS)} FROM readings")
def tonnage_silver(spark, d):
    return tonnage(spark, d).select(*READING_COLUMNS)


@case("plant_output", "SELECT * FROM plant_out")
def plant_output(spark, d):
    return crushing.plant_output(tonnage(spark, d))


@case(
    "belt_output",
    f"""SELECT location, flow_mode, adjusted_date, shift, count(*) AS reading_count, {rd("sum(tonnage_delta)", 2)} AS total_tonnage,
               {rd("avg(throughput_tph)", 2)} AS avg_throughput_tph, max(tonnage_total_today) AS totalizer_tonnage_eod
        FROM readings WHERE is_cv AND tonnage_delta IS NOT NULL GROUP BY ALL""",
)
def belt_output(spark, d):
    return crushing.belt_output(tonnage(spark, d))


@case("running_stats", "SELECT * FROM running")
def running_stats(spark, d):
    return running(spark, d)


SUMMARY_SQL = f"""
    SELECT o.adjusted_date AS date, o.shift, o.cp_name, o.total_tonnage AS total_tonnage_ton, o.total_volume, o.avg_throughput_tph,
           o.duration_hours AS reading_duration_hours, coalesce(h.hours, 0.0) AS running_hours, coalesce(h.share, 0.0) AS running_pct,
           CASE WHEN coalesce(h.hours, 0.0) > 0 THEN {rd("o.total_tonnage / CASE WHEN h.hours > 0 THEN h.hours END", 2)} END AS productivity_tph
    FROM plant_out o LEFT JOIN (
        SELECT cp_number AS cp_name, event_date AS adjusted_date, shift, {rd("avg(running_hours_est)", 2)} AS hours,
               {rd("avg(running_pct)", 2)} AS share FROM running GROUP BY ALL) h USING (cp_name, adjusted_date, shift)"""


@case("output_summary", SUMMARY_SQL)
def output_summary(spark, d):
    return crushing.output_summary(crushing.plant_output(tonnage(spark, d)), running(spark, d))


@case(
    "dashboard_output_tiles",
    f"""SELECT {rd("sum(total_tonnage_ton)", 2)} AS total_tonnage_ton, {rd("avg(avg_throughput_tph)", 2)} AS avg_throughput_tph,
               {rd("avg(running_pct)", 2)} AS running_pct, {rd("avg(productivity_tph)", 2)} AS productivity_tph FROM ({SUMMARY_SQL})""",
)
def dashboard_output_tiles(spark, d):
    return dashboards.output_tiles(output_summary(spark, d))


@case(
    "dashboard_rollup",
    f"""SELECT shift, cp_name, {rd("sum(total_tonnage_ton)", 4)} AS sum_total_tonnage_ton,
               {rd("avg(running_pct)", 4)} AS avg_running_pct FROM ({SUMMARY_SQL}) GROUP BY ALL""",
)
def dashboard_rollup(spark, d):
    return dashboards.rollup(output_summary(spark, d), ["shift", "cp_name"], ["total_tonnage_ton"], ["running_pct"])


@case(
    "dashboard_filter_counts",
    f"SELECT cp_name, count(*) FILTER (WHERE shift = 'Pagi') AS associated_rows FROM ({SUMMARY_SQL}) GROUP BY ALL",
)
def dashboard_filter_counts(spark, d):
    return dashboards.filter_counts(output_summary(spark, d), "cp_name", F.col("shift") == "Pagi")


@case(
    "cp_intake_with_output",
    f"""WITH made AS (SELECT date AS production_date, shift, upper(trim(cp_name)) AS cp_name_uc06, {rd("sum(total_tonnage_ton)", 3)} AS cp_output_ton,
                       {rd("avg(running_hours)", 2)} AS cp_running_hours, {rd("avg(productivity_tph)", 2)} AS cp_productivity_tph
                       FROM ({SUMMARY_SQL}) GROUP BY ALL)
        SELECT production_date, shift, cp_code, intake_ton, cp_output_ton, cp_running_hours, cp_productivity_tph,
               {rd("intake_ton - cp_output_ton", 3)} AS intake_vs_output_ton, {pct("cp_output_ton", "intake_ton")} AS crushing_recovery_pct
        FROM intake LEFT JOIN made USING (production_date, shift, cp_name_uc06)""",
)
def cp_intake_with_output(spark, d):
    rows = marts.plant_intake(dumping(spark, d), hauling(spark, d), output_summary(spark, d))
    return rows.select(
        "production_date", "shift", "cp_code", "intake_ton", "cp_output_ton", "cp_running_hours", "cp_productivity_tph",
        "intake_vs_output_ton", "crushing_recovery_pct",
    )


DENSITY_SQL = f"""
    SELECT *, {rd("density_realisasi - 0.88", 4)} AS density_deviation, {rd("(density_realisasi - 0.88) / 0.88 * 100.0", 2)} AS density_deviation_pct FROM (
        SELECT *, {rd("total_tonnage / total_volume", 4)} AS density_realisasi, 0.88::DOUBLE AS density_referensi FROM (
            SELECT adjusted_date, location, flow_mode, {rd("sum(tonnage_delta)", 2)} AS total_tonnage, {rd("sum(delta_volume)", 2)} AS total_volume
            FROM readings WHERE is_cv AND tonnage_delta IS NOT NULL AND delta_volume > 0 GROUP BY ALL))"""


@case("density_trend", DENSITY_SQL)
def density_trend(spark, d):
    return crushing.density_trend(tonnage(spark, d))


@case(
    "density_box",
    f"""SELECT location, count(*) AS n, min(density_realisasi) AS low, {rd("quantile_cont(density_realisasi, 0.25)", 6)} AS q1,
               {rd("quantile_cont(density_realisasi, 0.5)", 6)} AS median, {rd("quantile_cont(density_realisasi, 0.75)", 6)} AS q3,
               max(density_realisasi) AS high FROM ({DENSITY_SQL}) GROUP BY ALL HAVING count(*) > 1""",
)
def density_box(spark, d):
    """Box statistics of the daily density of each belt."""
    return crushing.box_stats(density_trend(spark, d), ["location"], "density_realisasi")


@case("belt_ratio", "SELECT * FROM belt_days")
def belt_ratio(spark, d):
    weighed = inputs.weighings(spark, d).withColumn("timestamp_gross_local", F.to_timestamp("timestamp_gross_local"))
    return crushing.belt_ratio(weighed, tonnage(spark, d))


@case(
    "belt_ratio_summary",
    f"""SELECT min(date) AS first_date, max(date) AS last_date, count(*) AS days, {rd("avg(wim_cv_ratio)", 4)} AS avg_ratio,
               min(wim_cv_ratio) AS min_ratio, max(wim_cv_ratio) AS max_ratio, count(*) FILTER (WHERE anomaly_flag) AS anomaly_days,
               {rd("avg(CAST(anomaly_flag AS INTEGER)) * 100", 2)} AS anomaly_pct FROM belt_days""",
)
def belt_ratio_summary(spark, d):
    return crushing.ratio_summary(belt_ratio(spark, d))


@case(
    "flow_by_shift",
    f"""SELECT adjusted_date, flow_mode, shift, {rd("sum(tonnage_delta)", 4)} AS total_tonnage, {rd("sum(delta_volume)", 4)} AS total_volume,
               count(*) AS reading_count
        FROM readings WHERE tonnage_delta IS NOT NULL AND flow_mode IN ('direct', 'non_direct') GROUP BY ALL""",
)
def flow_by_shift(spark, d):
    return crushing.flow_by_shift(tonnage(spark, d))


@case(
    "flow_mode_share",
    f"""SELECT *, {pct("total_tonnage", "grand_total")} AS share_pct FROM (
            SELECT *, {rd("sum(total_tonnage) OVER ()", 6)} AS grand_total FROM (
                SELECT flow_mode, {rd("sum(tonnage_delta)", 2)} AS total_tonnage, count(*) AS reading_count
                FROM readings WHERE tonnage_delta IS NOT NULL GROUP BY ALL) WHERE total_tonnage > 0)""",
)
def flow_mode_share(spark, d):
    return crushing.flow_mode_share(tonnage(spark, d))


@case(
    "throughput_box",
    f"""SELECT location, count(*) AS n, min(throughput_tph) AS low, {rd("quantile_cont(throughput_tph, 0.25)", 6)} AS q1,
               {rd("quantile_cont(throughput_tph, 0.5)", 6)} AS median, {rd("quantile_cont(throughput_tph, 0.75)", 6)} AS q3,
               max(throughput_tph) AS high FROM readings WHERE throughput_tph IS NOT NULL GROUP BY ALL HAVING count(*) > 1""",
)
def throughput_box(spark, d):
    return crushing.box_stats(tonnage(spark, d), ["location"], "throughput_tph")


@case(
    "tonnage_pivot",
    f"""SELECT cp_name, coalesce({rd("sum(total_tonnage) FILTER (WHERE shift = 'Pagi')", 2)}, 0) AS Pagi,
               coalesce({rd("sum(total_tonnage) FILTER (WHERE shift = 'Malam')", 2)}, 0) AS Malam FROM plant_out GROUP BY ALL""",
)
def tonnage_pivot(spark, d):
    return crushing.tonnage_pivot(crushing.plant_output(tonnage(spark, d)), "cp_name", "shift", ["Pagi", "Malam"])


@case("plant_totals", f"SELECT cp_name, {rd('sum(total_tonnage)', 2)} AS total_tonnage FROM plant_out GROUP BY ALL")
def plant_totals(spark, d):
    return crushing.totals_by(crushing.plant_output(tonnage(spark, d)), "cp_name")


# --- ordered scans over raw events --------------------------------------------------


@case(
    "counter_delta",
    """SELECT event_id, user_id, value, date_diff('second', date_trunc('second', lag(ts) OVER w), date_trunc('second', ts)) AS seconds,
              CASE WHEN value >= lag(value) OVER w THEN round(value - lag(value) OVER w, 4) END AS growth
       FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)""",
)
def counter_delta_events(spark, d):
    e = inputs.table(spark, d, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    rows = counter_delta(e, ["user_id"], "ts", "value", "growth", "seconds", ["event_id"])
    return rows.select("event_id", "user_id", "value", "seconds", F.round("growth", 4).alias("growth"))


@case(
    "previous_event",
    """SELECT event_id, user_id, lag(event_type) OVER w AS previous_type, lag(value) OVER w AS previous_value
       FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)""",
)
def previous_event(spark, d):
    e = inputs.table(spark, d, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    rows = previous_row(e, ["user_id"], ["ts", "event_id"], ["event_type", "value"], time_slot("ts", 180))
    return rows.select(
        "event_id", "user_id", F.col("previous.event_type").alias("previous_type"), F.col("previous.value").alias("previous_value")
    )


@case(
    "drop_repeats",
    """SELECT event_id, user_id, event_type FROM (
           SELECT *, ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) <= INTERVAL 20 MINUTE AS near FROM events)
       WHERE NOT coalesce(near AND event_type IN ('view', 'error'), FALSE)""",
)
def drop_repeats_events(spark, d):
    e = inputs.table(spark, d, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    e = e.withColumn("closed", F.when(~F.col("event_type").isin("view", "error"), F.col("event_type")))
    return drop_repeats(e, ["user_id"], "ts", "closed", 20, ["event_id"]).select("event_id", "user_id", "event_type")


# --- truck movement -----------------------------------------------------------------

MOVEMENT_COLUMNS = [
    "assignment_id_value", "truck_id_value", "lane_id_value", "tonnage_value", "queue_name", "created_at_ts",
    "vehicle_in_time_ts", "vehicle_out_time_ts", "transaction_date", "transaction_hour", "vehicle_movement_status",
    "data_quality_status",
]
DURATIONS = ["queue_duration_minutes", "cp_area_duration_minutes", "cp_process_duration_minutes"]


def movements(spark, d):
    return movement.movement_silver(inputs.queue_rows(spark, d))


@case(
    "movement_silver",
    f"""SELECT {', '.join(MOVEMENT_COLUMNS)}, {', '.join(f'round({c}, 6) AS {c}' for c in DURATIONS)},
               CAST(is_anomaly_bool AS VARCHAR) AS is_anomaly, CAST(is_anomaly_queue_lane_bool AS VARCHAR) AS is_anomaly_lane FROM queue""",
)
def movement_silver(spark, d):
    return movements(spark, d).select(
        *MOVEMENT_COLUMNS,
        *[F.round(c, 6).alias(c) for c in DURATIONS],
        F.col("is_anomaly_bool").cast("string").alias("is_anomaly"),
        F.col("is_anomaly_queue_lane_bool").cast("string").alias("is_anomaly_lane"),
    )


SQL_MEASURES = {
    "total_transaction": "count(DISTINCT assignment_id_value)",
    "total_vehicle": "count(DISTINCT truck_id_value)",
    "vehicle_in": "count(vehicle_in_time_ts)",
    "vehicle_out": "count(vehicle_out_time_ts)",
    "completed_transaction": "count(*) FILTER (WHERE status = 'COMPLETED')",
    "total_tonnage": rd("sum(tonnage_value)", 6),
    "avg_tonnage_per_vehicle": rd("avg(tonnage_value)", 6),
    "avg_queue_duration_minutes": rd("avg(queue_duration_minutes)", 6),
    "avg_cp_area_duration_minutes": rd("avg(cp_area_duration_minutes)", 6),
    "avg_cp_process_duration_minutes": rd("avg(cp_process_duration_minutes)", 6),
    "anomaly_count": "count(*) FILTER (WHERE is_anomaly_bool)",
    "anomaly_queue_lane_count": "count(*) FILTER (WHERE is_anomaly_queue_lane_bool)",
    "data_quality_issue_count": "count(*) FILTER (WHERE data_quality_status <> 'valid')",
    "total_rows": "count(*)",
}


def summary_sql(keys, measures, names=None) -> str:
    names = names or {}
    chosen = ", ".join(f"{SQL_MEASURES[m]} AS {names.get(m, m)}" for m in measures)
    return f"SELECT {', '.join([*keys, chosen])} FROM queue GROUP BY ALL"


ALL_BUT_ROWS = [m for m in SQL_MEASURES if m != "total_rows"]


@case(
    "vehicle_summary_daily",
    summary_sql(movement.DAILY, ALL_BUT_ROWS, {"vehicle_in": "total_vehicle_in", "vehicle_out": "total_vehicle_out"}),
)
def vehicle_summary_daily(spark, d):
    return movement.daily_summary(movements(spark, d))


@case(
    "vehicle_summary_hourly",
    summary_sql(movement.HOURLY, [m for m in ALL_BUT_ROWS if m[:4] in ("tota", "vehi", "avg_")]),
)
def vehicle_summary_hourly(spark, d):
    return movement.hourly_summary(movements(spark, d))


@case(
    "vehicle_summary_lane",
    summary_sql(
        movement.LANE,
        ["total_transaction", "total_vehicle", "vehicle_in", "vehicle_out", "total_tonnage", "avg_tonnage_per_vehicle",
         "avg_cp_process_duration_minutes", "avg_cp_area_duration_minutes", "anomaly_count", "data_quality_issue_count"],
    ),
)
def vehicle_summary_lane(spark, d):
    return movement.lane_summary(movements(spark, d))


@case("vehicle_kpis", summary_sql([], ALL_BUT_ROWS))
def vehicle_kpis(spark, d):
    return movement.vehicle_summary(movements(spark, d), (), ALL_BUT_ROWS)


@case("vehicle_hourly_trend", summary_sql(["transaction_date", "transaction_hour"], ["vehicle_in", "vehicle_out", "total_tonnage"]))
def vehicle_hourly_trend(spark, d):
    return movement.hourly_trend(movements(spark, d))


@case(
    "vehicle_output_per_plant",
    summary_sql(["queue_name"], ["total_transaction", "total_vehicle", "vehicle_in", "vehicle_out", "total_tonnage",
                                 "avg_cp_area_duration_minutes"]),
)
def vehicle_output_per_plant(spark, d):
    keep = ["total_transaction", "total_vehicle", "vehicle_in", "vehicle_out", "total_tonnage", "avg_cp_area_duration_minutes"]
    return movement.vehicle_summary(movements(spark, d), ["queue_name"], keep)


@case(
    "movement_exceptions",
    """SELECT transaction_date, queue_name, lane_id_value, truck_id_value, nomor_lambung, status, assigned_by, vehicle_movement_status,
              tonnage_value, data_quality_status FROM queue
       WHERE data_quality_status <> 'valid' OR vehicle_movement_status <> 'IN_OUT_COMPLETED' OR is_anomaly_bool OR is_anomaly_queue_lane_bool""",
)
def movement_exceptions(spark, d):
    return movement.exceptions(movements(spark, d)).select(
        "transaction_date", "queue_name", "lane_id_value", "truck_id_value", "nomor_lambung", "status", "assigned_by",
        "vehicle_movement_status", "tonnage_value", "data_quality_status",
    )


@case(
    "movement_status_share",
    f"""SELECT *, {pct("total_rows", "grand_total")} AS share_pct FROM (
            SELECT *, CAST(sum(total_rows) OVER () AS DOUBLE) AS grand_total FROM (
                SELECT vehicle_movement_status, count(*) AS total_rows FROM queue GROUP BY ALL))""",
)
def movement_status_share(spark, d):
    rows = distribution(movements(spark, d), ["vehicle_movement_status"])
    return rows.withColumn("grand_total", F.col("grand_total").cast("double"))
