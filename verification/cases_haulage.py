"""Haulage: cleaning, reconciliation, marts, suggestions."""

from __future__ import annotations

from pyspark.sql import functions as F

from tonflow.functions import times
from tonflow.operators.ordered import asof_join
from tonflow.plans import dashboards, funnel, marts, production, reconciliation, speed, stock, suggestions
from tonflow.plans import visits as visit_plans
from tonflow.plans import weighing
from tonflow.plans.checks import production_checks
from tonflow.plans.pipeline import Silver, build_gold, build_silver
from tonflow.settings import DEFAULTS
from tonflow.sources.session import cut_lineage
from tonflow.sources.tables import estimated_shipment
from verification import inputs
from verification.ctes import pct, rd
from verification.registry import case


# --- the parts ----------------------------------------------------------------------


def hauling(spark, d):
    return weighing.hauling_silver(weighing.weighing_bronze(inputs.weighings(spark, d), "TABLE"))


def visits(spark, d):
    return visit_plans.visit_silver(visit_plans.visit_bronze(inputs.visits(spark, d), "TABLE"))


def ledger(spark, d):
    return stock.stock_silver(stock.stock_bronze(inputs.movements(spark, d), "TABLE"))


def loading(spark, d):
    return visit_plans.rom_loading(visits(spark, d))


def dumping(spark, d):
    return visit_plans.plant_dumping(visits(spark, d))


def silver(spark, d) -> Silver:
    """Conformed tables written once, as a run of the marts has them."""
    return build_silver(
        inputs.weighings(spark, d), inputs.visits(spark, d), inputs.movements(spark, d), keep=cut_lineage
    )


def trips(s: Silver):
    return reconciliation.reconcile_trips(s.hauling, s.loading, s.dumping, s.ledger)


def funnel_rows(s: Silver):
    shipped = estimated_shipment(funnel.daily_intake(s.dumping), 0.985)
    return funnel.funnel(s.loading, s.hauling, s.ledger, s.dumping, shipped)


def contractors(s: Silver):
    return marts.contractor_daily(
        s.hauling, reconciliation.contractor_losses(reconciliation.trace_summary(trips(s)))
    )


def gold(spark, d):
    return build_gold(silver(spark, d))


# --- speed trend --------------------------------------------------------------------

CLOSING = f"""
    SELECT event_id, upper(unit) AS truck,
           CASE WHEN event_id % 15 = 0 THEN NULL WHEN event_id % 16 = 0 THEN -1.0 ELSE {rd("value % 16", 2)} END AS average_speed,
           CASE event_id % 3 WHEN 2 THEN 'MANUAL' ELSE 'ACTUAL' END AS status_trx_wim,
           CASE WHEN event_id % 60 <> 0 THEN ts + INTERVAL 8 HOUR END AS timestamp_in,
           ts + INTERVAL 8 HOUR + INTERVAL 9 MINUTE AS timestamp_out, upper(substr(unit, 1, 3)) AS company_code_standard
    FROM ev WHERE event_id % 40 <> 0
      AND (event_id % 15 = 0 OR event_id % 16 <> 0)"""
BAND = """CASE WHEN average_speed IS NULL THEN 'Undefined' WHEN average_speed < 7 THEN 'Kurang dari 7 Kpj'
          WHEN average_speed <= 10 THEN 'Antara 7 Kpj sampai 10 Kpj' ELSE 'Lebih dari 10 Kpj' END"""
TREND = f"""
    SELECT strftime(timestamp_in, '%Y-%m-%d') AS tanggal, {BAND} AS kecepatan, count(truck) AS jumlah_transaksi
    FROM closing WHERE status_trx_wim = 'ACTUAL' AND average_speed IS NOT NULL GROUP BY ALL"""


@case(
    "speed_trend_share",
    f"""SELECT *, {pct("jumlah_transaksi", "total_harian", 6)} AS percentage_of_day FROM (
            SELECT *, CAST(sum(jumlah_transaksi) OVER (PARTITION BY tanggal) AS BIGINT) AS total_harian
            FROM trend WHERE tanggal BETWEEN (SELECT min(tanggal) FROM trend) AND (SELECT max(tanggal) FROM trend))""",
    closing=CLOSING,
    trend=TREND,
)
def speed_trend_share(spark, d):
    silver = speed.closing_silver(inputs.closings(spark, d))
    return speed.speed_trend_share(speed.daily_speed_trend(silver))


@case(
    "closing_silver",
    f"""SELECT event_id AS id, average_speed, timestamp_in, timestamp_out, CAST(timestamp_in AS DATE) AS date,
               CAST(hour(timestamp_in) AS INTEGER) AS hour, CAST(dayofweek(timestamp_in) + 1 AS INTEGER) AS day_of_week,
               CAST(weekofyear(timestamp_in) AS INTEGER) AS week_of_year, CAST(month(timestamp_in) AS INTEGER) AS month,
               CAST(year(timestamp_in) AS INTEGER) AS year, CAST(timestamp_out AS DATE) AS operation_date, {BAND} AS speed_category,
               CAST(coalesce(average_speed BETWEEN 7 AND 10, FALSE) AS INTEGER) AS is_compliant, company_code_standard
        FROM closing""",
    closing=CLOSING,
)
def closing_silver(spark, d):
    return speed.closing_silver(inputs.closings(spark, d)).select(
        "id", "average_speed", "timestamp_in", "timestamp_out", "date", "hour", "day_of_week", "week_of_year",
        "month", "year", "operation_date", "speed_category", "is_compliant", "company_code_standard",
    )


# --- conformed tables ---------------------------------------------------------------

HAULING_COLUMNS = [
    "trip_id", "wim_id_src", "truck", "contractor_code", "contractor_name", "client", "rom_code", "dest_code",
    "flow_path", "material_code", "coal_type", "gross_ton", "netto_ton", "netto_ucan_ton", "netto_delta_wim_ucan_ton",
    "weigh_ts_utc", "rom_exit_ts_utc", "port_arrival_ts_utc", "rom_to_port_min", "ts_local", "date_local", "hour_local",
    "production_date", "shift", "week_start", "month", "status_trx_wim", "adjustment_result", "is_payload_anomaly",
    "has_wim_anomaly_msg",
]


# A flag that can be NULL is compared as text.
PAYLOAD_FLAG = "CAST(is_payload_anomaly AS VARCHAR) AS is_payload_anomaly"


def with_text_flag(df):
    return df.withColumn("is_payload_anomaly", F.col("is_payload_anomaly").cast("string"))


@case("hauling_silver", f"SELECT * REPLACE ({PAYLOAD_FLAG}) FROM (SELECT {', '.join(HAULING_COLUMNS)} FROM trips0)")
def hauling_silver(spark, d):
    return with_text_flag(hauling(spark, d).select(*HAULING_COLUMNS))


@case(
    "material_parts",
    """SELECT wim_id_src, split_part(material_code, '.', 1) AS material_block, split_part(material_code, '.', 2) AS material_seam,
              CASE WHEN len(string_split(material_code, '.')) > 2 THEN split_part(material_code, '.', 3) END AS material_quality,
              CASE WHEN len(string_split(material_code, '.')) > 3 THEN split_part(material_code, '.', 4) END AS material_product
       FROM hauling""",
)
def material_parts(spark, d):
    return hauling(spark, d).select("wim_id_src", "material_block", "material_seam", "material_quality", "material_product")


VISIT_COLUMNS = [
    "event_id", "truck", "contractor_code", "contractor_name", "node_code", "node_type", "gate_in", "gate_out",
    "time_in_utc", "time_out_utc", "dwell_minutes", "tonase_ton", "material_code", "rom_ticket_no", "loader_type",
    "capture_source", "ts_local", "date_local", "hour_local", "production_date", "shift", "week_start", "month",
    "is_stockpile_fleet", "is_anomaly_flag", "is_deleted_flag", "has_tonnage", "is_open_visit",
]


@case("visit_silver", f"SELECT {', '.join(VISIT_COLUMNS)} FROM visits")
def visit_silver(spark, d):
    return visits(spark, d).select(*VISIT_COLUMNS)


LEDGER_COLUMNS = [
    "stock_txn_id", "txn_ts_utc", "movement", "qty_ton", "signed_ton", "truck", "contractor_code", "contractor_name",
    "stockpile_code", "capture_source", "status", "is_final", "is_zero_qty", "production_date", "shift", "hour_local",
]


@case("stock_silver", f"SELECT {', '.join(LEDGER_COLUMNS)} FROM ledger")
def stock_silver(spark, d):
    return ledger(spark, d).select(*LEDGER_COLUMNS)


@case(
    "hauling_summary",
    f"""SELECT flow_path, rom_code, count(*) AS trips, {rd("sum(netto_ton)", 1)} AS netto_ton,
               {rd("avg(netto_ton)", 2)} AS avg_payload_ton FROM trips0 GROUP BY ALL""",
)
def hauling_summary(spark, d):
    return weighing.hauling_summary(hauling(spark, d))


@case("rom_loading", "SELECT event_id, truck, rom_code, left_ts AS rom_exit_ts_utc, tonase_ton FROM loading")
def rom_loading(spark, d):
    return loading(spark, d).select("event_id", "truck", "rom_code", "rom_exit_ts_utc", "tonase_ton")


@case("plant_dumping", "SELECT event_id, truck, cp_code, dump_ts_utc, source_leg, tonase_ton FROM dumping")
def plant_dumping(spark, d):
    return dumping(spark, d).select("event_id", "truck", "cp_code", "dump_ts_utc", "source_leg", "tonase_ton")


@case(
    "stockpile_directions",
    """SELECT event_id, truck, CASE WHEN upper(gate_in) LIKE '%GATE3%' THEN 'IN'
              WHEN upper(gate_out) LIKE '%GATE4%' OR upper(gate_out) LIKE '%GATE5%' THEN 'OUT' ELSE 'UNKNOWN' END AS direction
       FROM visits WHERE node_type = 'STOCKPILE' AND NOT is_deleted_flag""",
)
def stockpile_directions(spark, d):
    return visit_plans.stockpile_visits(visits(spark, d)).select("event_id", "truck", "direction")


@case(
    "tonnage_coverage",
    f"""SELECT node_type, count(*) AS events, count(*) FILTER (WHERE has_tonnage) AS events_with_ton,
               {rd("avg(CAST(has_tonnage AS INTEGER)) * 100", 1)} AS coverage_pct, {rd("sum(tonase_ton)", 1)} AS total_ton
        FROM visits WHERE node_type <> 'UNRESOLVED' GROUP BY ALL""",
)
def tonnage_coverage(spark, d):
    return visit_plans.tonnage_coverage(visits(spark, d))


@case(
    "operational_rollup",
    f"""WITH v AS (
            SELECT event_id, ts, unit, CASE event_type WHEN 'view' THEN trim([{", ".join(repr(x) for x in inputs.ROM_NAMES)}][CAST(event_id % 8 AS INTEGER) + 1])
                        WHEN 'click' THEN 'CP ' || (event_id % 9 + 1) WHEN 'error' THEN CASE WHEN event_id % 10 <> 0 THEN 'North Stockpile' END END AS place,
                   CASE WHEN event_id % 3 = 0 THEN 'PT Angkut' END AS kontraktor,
                   CASE WHEN event_id % 12 <> 0 THEN kg + again * 10 - (event_id % 5) * 20 ELSE 0 END AS tonase
            FROM (SELECT *, unnest(CASE WHEN event_id % 20 = 0 THEN [0, 1] ELSE [0] END) AS again FROM ev
                  WHERE event_type IN ('view', 'click', 'error')))
        SELECT CAST(ts - INTERVAL 6 HOUR AS DATE) AS op_date, CAST(hour(ts - INTERVAL 6 HOUR) AS INTEGER) AS op_hour,
               date_trunc('hour', ts - INTERVAL 6 HOUR) AS op_datetime, CAST(ts AS DATE) AS date, CAST(hour(ts) AS INTEGER) AS hour,
               CASE WHEN hour(ts) BETWEEN 6 AND 17 THEN 'DS' ELSE 'NS' END AS shift, place AS master_location, kontraktor,
               count(event_id) AS jumlah_transaksi, count(DISTINCT unit) AS jumlah_unit_aktif, {rd("sum(tonase)", 6)} AS tonase
        FROM v WHERE place IS NOT NULL AND kontraktor IS NOT NULL GROUP BY ALL""",
)
def operational_rollup(spark, d):
    return visit_plans.operational_rollup(visit_plans.visit_bronze(inputs.visits(spark, d), "TABLE"))


@case(
    "stockpile_rollup",
    f"""WITH v AS (
            SELECT ts, CASE event_id % 4 WHEN 0 THEN 'GATE3 IN' WHEN 1 THEN 'gate3' WHEN 2 THEN 'YARD IN' ELSE '' END AS came,
                   CASE event_id % 3 WHEN 0 THEN 'GATE4 OUT' WHEN 1 THEN 'gate5 out' ELSE '' END AS went,
                   CASE WHEN event_id % 12 <> 0 THEN kg + again * 10 - (event_id % 5) * 20 ELSE 0 END AS ton
            FROM (SELECT *, unnest(CASE WHEN event_id % 20 = 0 THEN [0, 1] ELSE [0] END) AS again FROM ev
                  WHERE event_type IN ('view', 'click', 'error'))),
        f AS (SELECT *, came LIKE '%IN%' AND ton > 0 AS i, went LIKE '%OUT' OR came LIKE '%OUT%' AS o FROM v)
        SELECT CAST(ts - INTERVAL 6 HOUR AS DATE) AS op_date, CASE WHEN hour(ts) BETWEEN 6 AND 17 THEN 'DS' ELSE 'NS' END AS shift,
               CAST(hour(ts) AS INTEGER) AS hour, count(*) FILTER (WHERE i) AS jumlah_inbound, count(*) FILTER (WHERE o) AS jumlah_outbound,
               count(*) FILTER (WHERE came <> '' AND went = '') AS jumlah_aktif_geofence, {rd("sum(ton)", 6)} AS jumlah_tonase,
               {rd("sum(CASE WHEN i THEN ton ELSE 0 END)", 6)} AS tonase_inbound, {rd("sum(CASE WHEN o THEN ton ELSE 0 END)", 6)} AS tonase_outbound
        FROM f GROUP BY ALL""",
)
def stockpile_rollup(spark, d):
    return visit_plans.stockpile_rollup(visit_plans.visit_bronze(inputs.visits(spark, d), "TABLE"))


# --- matching -----------------------------------------------------------------------

TRIP_OUT = [
    "trip_id", "truck", "contractor_code", "contractor_name", "rom_code", "dest_code", "flow_path", "netto_ton",
    "weigh_ts_utc", "production_date", "shift", "is_payload_anomaly", "rom_event_id", "rom_code_urise",
    "rom_event_ts_utc", "rom_ton_urise", "cp_event_id", "cp_code", "cp_dump_ts_utc", "cp_ton_urise", "cp_source_leg",
    "stock_in_txn_id", "stock_in_ts_utc", "stock_in_ton", "delta_rom_vs_wim_ton", "delta_wim_vs_cp_ton",
    "delta_rom_vs_cp_ton", "loss_pct_wim_vs_cp", "rom_code_mismatch", "is_matched_rom", "is_matched_cp",
    "is_matched_stock", "trip_status", "cycle_time_min",
]


@case("trip_reconciliation", f"SELECT * REPLACE ({PAYLOAD_FLAG}) FROM (SELECT {', '.join(TRIP_OUT)} FROM trips)")
def trip_reconciliation(spark, d):
    return with_text_flag(trips(silver(spark, d)).select(*TRIP_OUT))


@case(
    "trip_status_summary",
    f"""SELECT trip_status, count(*) AS trips, {rd("sum(netto_ton)", 1)} AS netto_ton, {rd("avg(loss_pct_wim_vs_cp)", 2)} AS avg_loss_pct
        FROM trips GROUP BY ALL""",
)
def trip_status_summary(spark, d):
    return reconciliation.status_summary(trips(silver(spark, d)))


def _asof(direction: str, condition: str = "TRUE") -> str:
    near = "r.ts <= l.ts AND r.ts >= l.ts - INTERVAL 8 HOUR" if direction == "backward" else "r.ts >= l.ts AND r.ts <= l.ts + INTERVAL 8 HOUR"
    order = "r.ts DESC" if direction == "backward" else "r.ts"
    return f"""
        WITH l AS (SELECT * FROM events WHERE event_type = 'purchase'), r AS (SELECT * FROM events WHERE event_type = 'view')
        SELECT l.event_id, l.user_id, l.ts, r.event_id AS near_id, r.ts AS near_ts, r.value AS near_value
        FROM l LEFT JOIN r ON l.user_id = r.user_id AND {near} AND {condition}
        QUALIFY row_number() OVER (PARTITION BY l.event_id ORDER BY {order} NULLS LAST, r.event_id) = 1"""


def _asof_query(spark, d, direction, when=None):
    e = inputs.table(spark, d, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    left = e.where("event_type = 'purchase'").select("event_id", "user_id", "ts", "value")
    right = e.where("event_type = 'view'").select(
        "user_id", F.col("event_id").alias("near_id"), F.col("ts").alias("near_ts"), F.col("value").alias("near_value")
    )
    return asof_join(left, right, ["user_id"], "ts", "near_ts", "near_id", direction, 8.0, when=when).drop("value")


@case("asof_backward", _asof("backward"))
def asof_backward(spark, d):
    return _asof_query(spark, d, "backward")


@case("asof_forward", _asof("forward"))
def asof_forward(spark, d):
    return _asof_query(spark, d, "forward")


@case("asof_conditional", _asof("forward", "l.value > 40"))
def asof_conditional(spark, d):
    return _asof_query(spark, d, "forward", F.col("value") > 40)


# --- marts --------------------------------------------------------------------------


@case("funnel_daily", "SELECT * FROM funnel")
def funnel_daily(spark, d):
    return funnel_rows(silver(spark, d))


@case("stage_pairs", "SELECT * FROM gaps")
def stage_pairs(spark, d):
    return funnel.stage_gaps(funnel_rows(silver(spark, d)))


@case("production_timeseries", "SELECT * FROM series")
def production_timeseries(spark, d):
    return production.production_series(production.daily_production(hauling(spark, d)))


@case("shipment_outlook", "SELECT * FROM outlook")
def shipment_outlook(spark, d):
    return production.shipment_outlook(production.daily_production(hauling(spark, d)))


@case("contractor_daily", "SELECT * FROM contractors")
def contractor_daily(spark, d):
    return contractors(silver(spark, d))


@case("rom_daily", "SELECT * FROM roms")
def rom_daily(spark, d):
    return marts.rom_daily(hauling(spark, d), loading(spark, d))


@case("cp_intake", "SELECT * FROM intake")
def cp_intake(spark, d):
    rows = marts.plant_intake(dumping(spark, d), hauling(spark, d))
    return rows.drop("cp_output_ton", "cp_running_hours", "cp_productivity_tph", "intake_vs_output_ton", "crushing_recovery_pct")


@case("stock_balance", "SELECT * FROM balance")
def stock_balance(spark, d):
    s = silver(spark, d)
    return stock.stock_balance(s.ledger, marts.plant_intake(s.dumping, s.hauling))


@case("loss_anomaly", "SELECT * FROM anomalies")
def loss_anomaly(spark, d):
    s = silver(spark, d)
    series = marts.loss_series(
        funnel.stage_gaps(funnel_rows(s)), contractors(s), marts.rom_daily(s.hauling, s.loading)
    )
    # Scoring reads the series three times; it is small, computing it is not.
    return marts.loss_anomalies(cut_lineage(series))


@case("kpi_snapshot", "SELECT * FROM kpis")
def kpi_snapshot(spark, d):
    return gold(spark, d)["kpi_snapshot"]


CANDIDATE_COLUMNS = [
    "production_date", "candidate_code", "category", "entity", "severity_score", "expected_gain_ton", "impact_score",
    "priority_score", "candidate_rank",
]


@case("suggestion_candidates", f"SELECT {', '.join(CANDIDATE_COLUMNS)} FROM candidates")
def suggestion_candidates(spark, d):
    return gold(spark, d)["suggestion_candidates"].select(*CANDIDATE_COLUMNS)


TOP_SQL = """
    SELECT c.production_date, c.candidate_rank AS rank, c.candidate_code, c.category, b.entity,
           c.candidate_code || ' - ' || c.entity AS title, b.expected_gain_ton,
           CASE WHEN c.priority_score >= 66 THEN 'HIGH' WHEN c.priority_score >= 33 THEN 'MEDIUM' ELSE 'LOW' END AS priority,
           b.priority_score, 'RULE_ENGINE' AS generated_by
    FROM candidates c JOIN (SELECT * FROM candidates QUALIFY row_number() OVER (
             PARTITION BY production_date, candidate_code ORDER BY candidate_rank) = 1) b USING (production_date, candidate_code)
    WHERE c.candidate_rank <= 3"""
TOP_COLUMNS = [
    "production_date", "rank", "candidate_code", "category", "entity", "title", "expected_gain_ton", "priority",
    "priority_score", "generated_by",
]


@case("suggestion_top3", TOP_SQL)
def suggestion_top3(spark, d):
    return gold(spark, d)["suggestion_daily"].select(*TOP_COLUMNS)


ANSWERED = "candidate_rank = 2 AND day(production_date) % 2 = 0"


@case(
    "suggestion_merged",
    f"""SELECT * FROM ({TOP_SQL}) WHERE production_date NOT IN (SELECT production_date FROM candidates WHERE {ANSWERED})
        UNION ALL SELECT c.production_date, 1, c.candidate_code, c.category, b.entity, 'model', b.expected_gain_ton, 'LOW', b.priority_score, 'MODEL'
        FROM candidates c JOIN (SELECT * FROM candidates QUALIFY row_number() OVER (
                 PARTITION BY production_date, candidate_code ORDER BY candidate_rank) = 1) b USING (production_date, candidate_code)
        WHERE c.candidate_rank = 2 AND day(c.production_date) % 2 = 0""",
)
def suggestion_merged(spark, d):
    """Days that a model answered use its answer, all others the rules; figures come from the candidates."""
    candidates = gold(spark, d)["suggestion_candidates"]
    rules = suggestions.rule_suggestions(candidates, DEFAULTS)
    answers = rules.where("rank = 2 AND day(production_date) % 2 = 0").withColumns(
        {"rank": F.lit(1), "title": F.lit("model"), "expected_gain_ton": F.lit(-1.0), "priority": F.lit("LOW"),
         "generated_by": F.lit("MODEL")}
    )
    return suggestions.top_suggestions(candidates, answers).select(*TOP_COLUMNS)


@case("suggestion_payload")
def suggestion_payload(spark, d):
    marts_ = gold(spark, d)
    return suggestions.daily_payload(marts_["suggestion_candidates"], marts_["kpi_snapshot"])


@case(
    "suggestion_model_answers",
    """SELECT CAST(ts AS DATE) AS production_date, CAST(1 AS INTEGER) AS rank, 'CODE_' || event_type AS candidate_code,
              CASE WHEN event_id % 2 = 0 THEN 'Tim A' ELSE 'Manajer Produksi' END AS owner, CAST(event_id AS DOUBLE) AS expected_gain_ton,
              'MEDIUM' AS priority, 0.7 AS confidence
       FROM events WHERE event_id % 3 <> 0""",
)
def suggestion_model_answers(spark, d):
    """JSON answers inside prose and code fences, some without any JSON; one per event."""
    e = inputs.table(spark, d, "events")
    n = F.col("event_id").cast("string")
    owner = F.when(F.col("event_id") % 2 == 0, F.lit(',"owner":"Tim A"')).otherwise(F.lit(""))
    item = F.concat(
        F.lit('{"rank":1,"candidate_code":"CODE_'), F.col("event_type"), F.lit('","expected_gain_ton":'), n, owner, F.lit("}")
    )
    low = F.concat(F.lit('{"rank":4,"candidate_code":"X"}'))
    response = F.when(F.col("event_id") % 3 == 0, F.lit("No suggestion today.")).otherwise(
        F.concat(F.lit("Here you go:\n```json\n["), item, F.lit(", "), low, F.lit("]\n```"))
    )
    answers = e.select(F.col("ts").cast("date").alias("production_date"), response.alias("response"))
    return suggestions.parsed_answers(answers, "response").select(
        "production_date", "rank", "candidate_code", "owner", "expected_gain_ton", "priority", "confidence"
    )


@case(
    "dq_checks",
    f"""SELECT 'unique_trip_id' AS check_name, 'BLOCKING' AS level, CAST(count(*) - count(DISTINCT trip_id) AS DOUBLE) AS value, 0.0 AS threshold,
               count(*) = count(DISTINCT trip_id) AS passed FROM trips0
        UNION ALL SELECT 'netto_positive', 'BLOCKING', CAST(count(*) FILTER (WHERE netto_ton IS NULL OR netto_ton <= 0) AS DOUBLE), 0.0,
               count(*) FILTER (WHERE netto_ton IS NULL OR netto_ton <= 0) = 0 FROM trips0
        UNION ALL SELECT 'payload_in_range', 'WARNING', v, 2.0, v <= 2.0 FROM (SELECT {rd("count(*) FILTER (WHERE is_payload_anomaly) * 100.0 / count(*)", 2)} AS v FROM trips0)
        UNION ALL SELECT 'rom_resolved', 'WARNING', v, 5.0, v <= 5.0 FROM (SELECT {rd("count(*) FILTER (WHERE rom_code = 'UNKNOWN') * 100.0 / count(*)", 2)} AS v FROM trips0)
        UNION ALL SELECT 'node_resolved', 'WARNING', v, 5.0, v <= 5.0 FROM (SELECT {rd("count(*) FILTER (WHERE node_type = 'UNRESOLVED') * 100.0 / count(*)", 2)} AS v FROM visits)
        UNION ALL SELECT 'stock_qty_positive', 'WARNING', v, 10.0, v <= 10.0 FROM (SELECT {rd("count(*) FILTER (WHERE is_zero_qty) * 100.0 / count(*)", 2)} AS v FROM ledger)
        UNION ALL SELECT 'trip_trace_rate', 'WARNING', v, 80.0, v >= 80.0 FROM (SELECT {rd("count(*) FILTER (WHERE is_matched_cp) * 100.0 / count(*)", 2)} AS v FROM trips)
        UNION ALL SELECT 'funnel_monotonic', 'BLOCKING', CAST(v AS DOUBLE), 0.0, v <= 0 FROM (
            SELECT count(*) FILTER (WHERE CP_INTAKE > (coalesce(HAULING_WEIGHED, 0) + coalesce(STOCKPILE_OUT, 0)) * 1.05) AS v FROM wide)
        UNION ALL SELECT 'no_missing_days', 'WARNING', CAST(v AS DOUBLE), 0.0, v <= 0 FROM (
            SELECT max(production_date) - min(production_date) + 1 - count(DISTINCT production_date) AS v FROM daily)""",
)
def dq_checks(spark, d):
    s = silver(spark, d)
    log = production_checks(
        s.hauling, s.visits, s.ledger, trips(s), funnel_rows(s), production.daily_production(s.hauling)
    )
    return log.select("check_name", "level", "value", "threshold", "passed")


# --- dashboards ---------------------------------------------------------------------


@case(
    "dashboard_funnel",
    f"""SELECT stage_seq, stage_code, stage_name, stage_branch, source_system, {rd("sum(tonnage_ton)", 1)} AS tonnage_ton,
               CAST(sum(trips) AS BIGINT) AS trips, {rd("avg(pct_of_baseline)", 1)} AS pct_of_hauling
        FROM funnel WHERE production_date BETWEEN DATE '2024-01-05' AND DATE '2024-01-25' GROUP BY ALL""",
)
def dashboard_funnel(spark, d):
    return dashboards.funnel_view(funnel_rows(silver(spark, d)), "2024-01-05", "2024-01-25")


@case(
    "dashboard_losses",
    """SELECT production_date, pair_label, gap_type, upstream_ton, downstream_ton, delta_ton, loss_pct, recovery_pct, severity
       FROM gaps WHERE production_date BETWEEN DATE '2024-01-05' AND DATE '2024-01-25'""",
)
def dashboard_losses(spark, d):
    return dashboards.loss_view(funnel.stage_gaps(funnel_rows(silver(spark, d))), "2024-01-05", "2024-01-25")


@case(
    "dashboard_trend",
    """SELECT grain, period_label, period_start, actual_ton, target_ton, variance_ton, achievement_pct, ma7_actual_ton, status
       FROM series WHERE grain = 'WEEKLY'""",
)
def dashboard_trend(spark, d):
    series = production.production_series(production.daily_production(hauling(spark, d)))
    return dashboards.trend_view(series, "WEEKLY")


@case(
    "dashboard_contractors",
    """SELECT production_date, shift, contractor_name, netto_ton, trips, active_trucks, trips_per_truck, fleet_avg_trips_per_truck,
              productivity_gap_pct, avg_payload_ton, share_pct, avg_loss_pct, balancing_flag
       FROM contractors WHERE production_date = DATE '2024-01-10'""",
)
def dashboard_contractors(spark, d):
    return dashboards.contractor_view(contractors(silver(spark, d)), "2024-01-10")


@case(
    "dashboard_stock",
    """SELECT hour_start_utc, in_ton, out_ton, net_ton, balance_ton, days_of_cover, buffer_status
       FROM balance WHERE production_date BETWEEN DATE '2024-01-05' AND DATE '2024-01-25'""",
)
def dashboard_stock(spark, d):
    s = silver(spark, d)
    balance = stock.stock_balance(s.ledger, marts.plant_intake(s.dumping, s.hauling))
    return dashboards.stock_view(balance, "2024-01-05", "2024-01-25")


@case(
    "dashboard_suggestions",
    f"""SELECT production_date, rank, priority, category, title, expected_gain_ton, generated_by FROM ({TOP_SQL})
        WHERE production_date = (SELECT max(production_date) FROM candidates)""",
)
def dashboard_suggestions(spark, d):
    found = dashboards.latest_suggestions_view(gold(spark, d)["suggestion_daily"])
    return found.select("production_date", "rank", "priority", "category", "title", "expected_gain_ton", "generated_by")


# --- time labels --------------------------------------------------------------------


@case(
    "time_labels",
    """SELECT event_id, CASE CAST(hour(ts) AS INTEGER) // 6 WHEN 0 THEN '00:00-05:59' WHEN 1 THEN '06:00-11:59' WHEN 2 THEN '12:00-17:59' ELSE '18:00-23:59' END AS interval_label,
              ['Minggu', 'Senin', 'Selasa', 'Rabu', 'Kamis', 'Jumat', 'Sabtu'][CAST(dayofweek(ts) AS INTEGER) + 1] AS weekday,
              year(ts) || '-W' || lpad(CAST(weekofyear(ts) AS VARCHAR), 2, '0') AS week, isoyear(ts) || '-W' || lpad(CAST(weekofyear(ts) AS VARCHAR), 2, '0') AS iso_week,
              'W' || weekofyear(date_trunc('week', ts)) || '-' || year(date_trunc('week', ts)) AS week_period,
              CAST(ts - INTERVAL 6 HOUR AS DATE) AS production_date, CASE WHEN hour(ts) BETWEEN 6 AND 17 THEN 'Pagi' ELSE 'Malam' END AS shift,
              CAST(hour(ts - INTERVAL 6 HOUR) AS INTEGER) AS shifted_hour, strftime(ts, '%Y-%m') AS month, CAST(day(last_day(ts)) AS INTEGER) AS month_days,
              ts + INTERVAL 8 HOUR AS local_ts, CAST(ts AS DATE) - INTERVAL 3 MONTH AS three_months_back
       FROM events""",
)
def time_labels(spark, d):
    ts = F.col("ts").cast("timestamp")
    return inputs.table(spark, d, "events").select(
        "event_id",
        times.quarter_day(ts).alias("interval_label"),
        times.day_name(ts).alias("weekday"),
        times.week_label(ts).alias("week"),
        times.week_label(ts, iso_year=True).alias("iso_week"),
        times.week_period_label(times.week_start(ts)).alias("week_period"),
        times.production_date(ts).alias("production_date"),
        times.shift_label(ts).alias("shift"),
        times.shifted_hour(ts).alias("shifted_hour"),
        times.month_key(ts).alias("month"),
        times.days_in_month(ts).alias("month_days"),
        times.to_local(ts).alias("local_ts"),
        F.add_months(F.to_date(ts), -3).cast("timestamp").alias("three_months_back"),
    )
