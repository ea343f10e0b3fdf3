"""The same derivations in DuckDB SQL, written from the definitions, as named CTEs."""

from __future__ import annotations

import re

from tonflow.settings import CONTRACTORS, DEFAULTS, STAGE_PAIRS
from verification.inputs import CODES, PLACES, PORT_NAMES, ROM_NAMES


def text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def listed(values) -> str:
    return "[" + ", ".join(text(v) for v in values) + "]"


def rd(expr: str, digits: int) -> str:
    """Half-up rounding of a double at a fixed number of digits."""
    return f"CAST(round(CAST(({expr}) AS DECIMAL(38,{digits + 6})), {digits}) AS DOUBLE)"


def pct(part: str, whole: str, digits: int = 2) -> str:
    return f"CASE WHEN ({whole}) > 0 THEN {rd(f'({part}) / ({whole}) * 100.0', digits)} END"


def mapped(key: str, mapping: dict, default: str) -> str:
    whens = " ".join(f"WHEN {text(str(k))} THEN {text(v) if isinstance(v, str) else v}" for k, v in mapping.items())
    return f"CASE {key} {whens} ELSE {default} END"


def pick(values, index: str) -> str:
    return f"{listed(values)}[CAST(({index}) AS INTEGER) + 1]"


def calendar(ts: str) -> str:
    """Local time, production day, shift, week and month of a UTC column."""
    local = f"({ts} + INTERVAL 8 HOUR)"
    day = f"CAST({local} - INTERVAL 6 HOUR AS DATE)"
    return f"""
        {local} AS ts_local, CAST({local} AS DATE) AS date_local,
        CAST(hour({local}) AS INTEGER) AS hour_local, {day} AS production_date,
        CASE WHEN hour({local}) BETWEEN 6 AND 17 THEN 'Pagi' ELSE 'Malam' END AS shift,
        CAST(date_trunc('week', {day}) AS DATE) AS week_start,
        strftime({day}, '%Y-%m') AS month"""


def rom(name: str) -> str:
    n = f"upper(trim({name}))"
    return f"""CASE
        WHEN regexp_matches({n}, '^ROM\\s*A\\s*1') THEN 'ROM-A1'
        WHEN regexp_matches({n}, '^ROM\\s*A\\s*2') THEN 'ROM-A2'
        WHEN regexp_matches({n}, '^ROM\\s*A\\s*3') THEN 'ROM-A3'
        WHEN regexp_matches({n}, '^ROM\\s*B\\s*1') THEN 'ROM-B1'
        WHEN regexp_matches({n}, '^ROM\\s*B\\s*2') THEN 'ROM-B2'
        WHEN regexp_matches({n}, 'PIT\\s*C') THEN 'PIT-C-APL'
        WHEN {n} IN ('ROM-A1', 'ROM-A2', 'ROM-A3') THEN {n}
        ELSE 'UNKNOWN' END"""


def dest(name: str) -> str:
    n = f"upper(trim({name}))"
    number = f"regexp_extract({n}, 'CP[\\s\\-_]*([0-9]+[AB]?)', 1)"
    return f"""CASE
        WHEN {n} LIKE '%STOCKPILE%' THEN 'NORTH-STOCKPILE'
        WHEN {number} <> '' THEN 'CP-' || {number}
        WHEN {n} LIKE '%PORT%' THEN 'PORT-BIB'
        ELSE 'UNKNOWN' END"""


def prefix(truck: str) -> str:
    return f"upper(regexp_extract(trim({truck}), '^([A-Za-z]+)', 1))"


def named(code: str) -> str:
    return mapped(code, CONTRACTORS, "'UNKNOWN'")


def month_target(month: str) -> str:
    return mapped(month, DEFAULTS.month_targets, str(DEFAULTS.month_target_ton))


def days(day: str) -> str:
    return f"day(last_day({day}))"


N = "event_id"
MATERIAL = (
    f"CASE WHEN {N} % 10 = 0 THEN 'RA1.SEAM2' ELSE 'RA' || ({N} % 3 + 1) || '.SEAM' || ({N} % 4) || '.BR.ST' END"
)

CTES: dict[str, str] = {}

CTES["ev"] = f"""
    SELECT event_id, date_trunc('second', ts) AS ts, user_id, event_type, value, props,
           {pick(CODES, f"user_id % {len(CODES)}")} || ' ' || lpad(CAST(user_id AS VARCHAR), 4, '0') AS unit,
           CAST(round(value * 100) AS BIGINT) + 20000 AS kg
    FROM events"""

CTES["hauling"] = f"""
    WITH raw AS (
        SELECT *, CAST(100000000000000000 + {N} AS VARCHAR) AS id,
               upper(unit) AS truck_no,
               CASE {N} % 3 WHEN 0 THEN 'KUSAN' WHEN 1 THEN 'GIRIMULYA' END AS client_name,
               CASE WHEN {N} % 6 = 0 THEN 'GEC' WHEN {N} % 6 = 1 THEN upper(substr(unit, 1, 3)) END AS given_code,
               {pick(ROM_NAMES, f"{N} % 8")} AS rom_name,
               {pick(PORT_NAMES, f"({N} * 7 + user_id) % 5")} AS port_name,
               CASE WHEN {N} % 50 <> 0 THEN kg END AS netto_kg
        FROM ev WHERE event_type = 'purchase'
    ), once AS (
        SELECT * FROM raw QUALIFY row_number() OVER (PARTITION BY truck_no, ts ORDER BY id) = 1
    )
    SELECT sha256(truck_no || '|' || strftime(ts, '%Y-%m-%d %H:%M:%S')) AS trip_id,
           id AS wim_id_src, truck_no AS truck,
           coalesce(given_code, {prefix("truck_no")}) AS contractor_code,
           {named(f"coalesce(given_code, {prefix('truck_no')})")} AS contractor_name,
           client_name AS client, {rom("rom_name")} AS rom_code,
           {dest("CASE WHEN port_name <> '\\N' THEN port_name END")} AS dest_code,
           {MATERIAL} AS material_code,
           CASE WHEN {N} % 2 = 0 THEN 'RTP' ELSE 'PTP' END AS coal_type,
           (kg + 12000) / 1000.0 AS gross_ton,
           netto_kg / 1000.0 AS netto_ton, (kg - ({N} % 7) * 10) / 1000.0 AS netto_ucan_ton,
           ts AS weigh_ts_utc,
           CASE WHEN {N} % 9 <> 0 THEN ts - to_minutes(20 + {N} % 60) END AS rom_exit_ts_utc,
           ts + to_minutes(15 + {N} % 90) AS port_arrival_ts_utc,
           {calendar("ts")},
           CASE {N} % 5 WHEN 3 THEN 'MANUAL' ELSE 'ACTUAL' END AS status_trx_wim,
           CASE WHEN {N} % 11 = 0 THEN 'Adjust' END AS adjustment_result,
           {N} % 13 = 0 AS has_wim_anomaly_msg
    FROM once"""

CTES["trips0"] = f"""
    SELECT *, CASE WHEN dest_code = 'NORTH-STOCKPILE' THEN 'VIA_STOCKPILE'
                   WHEN dest_code LIKE 'CP-%' THEN 'DIRECT_CP'
                   WHEN dest_code = 'PORT-BIB' THEN 'DIRECT_PORT' ELSE 'UNKNOWN' END AS flow_path,
           netto_ton < 25 OR netto_ton > 80 AS is_payload_anomaly,
           {rd("netto_ton - netto_ucan_ton", 3)} AS netto_delta_wim_ucan_ton,
           {rd("date_diff('second', rom_exit_ts_utc, port_arrival_ts_utc) / 60.0", 1)} AS rom_to_port_min
    FROM hauling"""

CTES["visits"] = f"""
    WITH raw AS (
        SELECT *, unnest(CASE WHEN {N} % 20 = 0 THEN [0, 1] ELSE [0] END) AS again
        FROM ev WHERE event_type IN ('view', 'click', 'error')
    ), latest AS (
        SELECT * FROM raw QUALIFY row_number() OVER (PARTITION BY {N} ORDER BY again DESC) = 1
    ), placed AS (
        SELECT *, CASE event_type WHEN 'view' THEN {pick(ROM_NAMES, f"{N} % 8")}
                                  WHEN 'click' THEN 'CP ' || ({N} % 9 + 1)
                                  ELSE CASE WHEN {N} % 10 <> 0 THEN 'North Stockpile' END END AS place
        FROM latest
    ), coded AS (
        SELECT *, CASE WHEN upper(trim(place)) LIKE 'ROM%' THEN {rom("place")}
                       WHEN upper(place) LIKE '%STOCKPILE%' THEN 'NORTH-STOCKPILE'
                       WHEN upper(trim(place)) LIKE 'CP%' THEN {dest("place")}
                       ELSE 'UNRESOLVED' END AS node_code
        FROM placed
    )
    SELECT {N} AS event_id, upper(unit) AS truck, {prefix("unit")} AS contractor_code,
           CASE WHEN {N} % 3 = 0 THEN 'PT Angkut' ELSE {named(prefix("unit"))} END AS contractor_name,
           node_code,
           CASE WHEN node_code LIKE 'ROM%' OR node_code LIKE 'PIT%' THEN 'ROM'
                WHEN node_code = 'NORTH-STOCKPILE' THEN 'STOCKPILE'
                WHEN node_code LIKE 'CP-%' THEN 'CP' ELSE 'UNRESOLVED' END AS node_type,
           CASE {N} % 4 WHEN 0 THEN 'GATE3 IN' WHEN 1 THEN 'gate3' WHEN 2 THEN 'YARD IN' END AS gate_in,
           CASE {N} % 3 WHEN 0 THEN 'GATE4 OUT' WHEN 1 THEN 'gate5 out' END AS gate_out,
           ts AS time_in_utc,
           CASE WHEN {N} % 6 <> 0 THEN ts + to_minutes(5 + {N} % 40) END AS time_out_utc,
           CASE WHEN {N} % 6 <> 0 THEN CAST(5 + {N} % 40 AS DOUBLE) END AS dwell_minutes,
           CASE WHEN {N} % 12 <> 0 THEN (kg + again * 10 - ({N} % 5) * 20) / 1000.0 END AS tonase_ton,
           {MATERIAL} AS material_code, 'SK' || ({N} % 100) AS rom_ticket_no,
           CASE WHEN {N} % 2 = 0 THEN 'EXCA' ELSE 'TLS' END AS loader_type,
           CASE WHEN {N} % 2 = 0 THEN 'RFID' ELSE 'GEOFENCE' END AS capture_source,
           {calendar("ts")},
           {prefix("unit")} IN ('TMR', 'PDT', 'EST') AS is_stockpile_fleet,
           {N} % 31 = 0 AS is_anomaly_flag, {N} % 41 = 0 AS is_deleted_flag,
           {N} % 12 <> 0 AS has_tonnage, {N} % 6 = 0 AS is_open_visit
    FROM coded"""

CTES["loading"] = """
    SELECT * EXCLUDE (node_code), node_code AS rom_code, coalesce(time_out_utc, time_in_utc) AS left_ts
    FROM visits WHERE node_type = 'ROM' AND NOT is_deleted_flag"""

CTES["dumping"] = """
    SELECT * EXCLUDE (node_code), node_code AS cp_code, coalesce(time_out_utc, time_in_utc) AS dump_ts_utc,
           CASE WHEN is_stockpile_fleet THEN 'FROM_STOCKPILE' ELSE 'FROM_ROM_DIRECT' END AS source_leg
    FROM visits WHERE node_type = 'CP' AND NOT is_deleted_flag"""

CTES["ledger"] = f"""
    WITH raw AS (
        SELECT *, CASE WHEN {N} % 30 = 0 THEN 'ADJ' WHEN event_type = 'signup' THEN 'IN' ELSE 'OUT' END AS movement,
               CASE WHEN {N} % 25 = 0 THEN 0.0 ELSE kg / 1000.0 END AS qty_ton,
               CASE WHEN {N} % 15 <> 0 THEN upper(unit) END AS truck
        FROM ev WHERE event_type IN ('signup', 'error')
    )
    SELECT {N} AS stock_txn_id, ts AS txn_ts_utc, movement, qty_ton,
           CASE movement WHEN 'IN' THEN qty_ton WHEN 'OUT' THEN -qty_ton ELSE 0.0 END AS signed_ton,
           truck, {prefix("truck")} AS contractor_code, {named(prefix("truck"))} AS contractor_name,
           'NORTH STOCKPILE' AS stockpile_code,
           CASE WHEN {N} % 2 = 0 THEN 'RFID' ELSE 'GEOFENCE' END AS capture_source,
           CASE {N} % 3 WHEN 2 THEN 'DRAFT' ELSE 'FINAL' END AS status,
           {N} % 3 <> 2 AS is_final, qty_ton <= 0 AS is_zero_qty,
           {calendar("ts")}
    FROM raw"""


def leg(name: str, left: str, right: str, right_ts: str, tie: str, direction: str, extra: str = "TRUE") -> str:
    """Nearest event of the same truck within eight hours, by range join and rank."""
    if direction == "backward":
        near = f"r.{right_ts} <= l.weigh_ts_utc AND r.{right_ts} >= l.weigh_ts_utc - INTERVAL 8 HOUR"
        order = f"r.{right_ts} DESC"
    else:
        near = f"r.{right_ts} >= l.weigh_ts_utc AND r.{right_ts} <= l.weigh_ts_utc + INTERVAL 8 HOUR"
        order = f"r.{right_ts}"
    return f"""
    SELECT l.trip_id, r.* FROM {left} l JOIN {right} r ON l.truck = r.truck AND {near} AND {extra}
    QUALIFY row_number() OVER (PARTITION BY l.trip_id ORDER BY {order}, r.{tie}) = 1"""


CTES["leg_rom"] = leg("rom", "trips0", "loading", "left_ts", "event_id", "backward")
CTES["leg_cp"] = leg("cp", "trips0", "dumping", "dump_ts_utc", "event_id", "forward")
CTES["leg_stock"] = leg(
    "stock", "trips0", "ledger", "txn_ts_utc", "stock_txn_id", "forward",
    "l.flow_path = 'VIA_STOCKPILE' AND r.movement = 'IN'",
)

CTES["trips"] = f"""
    SELECT t.trip_id, t.truck, t.contractor_code, t.contractor_name, t.rom_code, t.dest_code, t.flow_path,
           t.netto_ton, t.weigh_ts_utc, t.production_date, t.shift, t.is_payload_anomaly,
           r.event_id AS rom_event_id, r.rom_code AS rom_code_urise, r.left_ts AS rom_event_ts_utc,
           r.tonase_ton AS rom_ton_urise,
           c.event_id AS cp_event_id, c.cp_code, c.dump_ts_utc AS cp_dump_ts_utc,
           c.tonase_ton AS cp_ton_urise, c.source_leg AS cp_source_leg,
           s.stock_txn_id AS stock_in_txn_id, s.txn_ts_utc AS stock_in_ts_utc, s.qty_ton AS stock_in_ton,
           {rd("r.tonase_ton - t.netto_ton", 3)} AS delta_rom_vs_wim_ton,
           {rd("t.netto_ton - c.tonase_ton", 3)} AS delta_wim_vs_cp_ton,
           {rd("r.tonase_ton - c.tonase_ton", 3)} AS delta_rom_vs_cp_ton,
           {pct("t.netto_ton - c.tonase_ton", "t.netto_ton")} AS loss_pct_wim_vs_cp,
           coalesce(r.rom_code <> t.rom_code, FALSE) AS rom_code_mismatch,
           r.event_id IS NOT NULL AS is_matched_rom, c.event_id IS NOT NULL AS is_matched_cp,
           s.stock_txn_id IS NOT NULL AS is_matched_stock,
           CASE WHEN r.event_id IS NOT NULL AND c.event_id IS NOT NULL THEN 'FULL_TRACE'
                WHEN c.event_id IS NOT NULL THEN 'CP_ONLY'
                WHEN r.event_id IS NOT NULL THEN 'ROM_ONLY' ELSE 'WEIGH_ONLY' END AS trip_status,
           {rd("date_diff('second', r.left_ts, c.dump_ts_utc) / 60.0", 1)} AS cycle_time_min
    FROM trips0 t LEFT JOIN leg_rom r USING (trip_id) LEFT JOIN leg_cp c USING (trip_id)
         LEFT JOIN leg_stock s USING (trip_id)"""

CTES["losses"] = f"""
    SELECT production_date, shift, contractor_code,
           {rd("avg(loss_pct_wim_vs_cp)", 2)} AS avg_loss_pct,
           {rd("sum(delta_wim_vs_cp_ton)", 3)} AS total_loss_ton, count(*) AS traced_trips
    FROM trips WHERE is_matched_cp GROUP BY ALL"""

CTES["intake_by_day"] = """
    SELECT production_date, sum(tonase_ton) AS cp_intake_ton FROM dumping WHERE has_tonnage GROUP BY ALL"""


def stage(seq: int, code: str, label: str, branch: str, system: str, source: str, where: str, ton: str) -> str:
    return f"""
    SELECT production_date, {seq} AS stage_seq, '{code}' AS stage_code, '{label}' AS stage_name,
           '{branch}' AS stage_branch, '{system}' AS source_system, {rd(f"sum({ton})", 3)} AS tonnage_ton,
           count(*) AS trips, count(DISTINCT truck) AS distinct_units, FALSE AS is_estimated
    FROM {source} WHERE {where} GROUP BY production_date"""


CTES["stages"] = " UNION ALL ".join([
    stage(1, "ROM_PRODUCTION", "ROM Production", "MAIN", "URISE", "loading", "has_tonnage", "tonase_ton"),
    stage(2, "HAULING_WEIGHED", "Hauling (WIM/Ucan)", "MAIN", "WIM_UCAN", "trips0", "TRUE", "netto_ton"),
    stage(3, "HAULING_DIRECT_CP", "Direct ROM -> CP", "DIRECT", "WIM_UCAN", "trips0", "flow_path = 'DIRECT_CP'", "netto_ton"),
    stage(4, "STOCKPILE_IN", "Stockpile IN", "BUFFER", "USCAVIS", "ledger", "movement = 'IN'", "qty_ton"),
    stage(5, "STOCKPILE_OUT", "Stockpile OUT/Reclaim", "BUFFER", "USCAVIS", "ledger", "movement = 'OUT'", "qty_ton"),
    stage(6, "CP_INTAKE", "Crushing Plant Intake", "MAIN", "URISE", "dumping", "has_tonnage", "tonase_ton"),
]) + f"""
    UNION ALL SELECT production_date, 7, 'SHIPMENT', 'Shipment', 'MAIN', 'ESTIMATED = cp_intake x 0.985',
           {rd("cp_intake_ton * 0.985", 3)}, NULL, NULL, TRUE FROM intake_by_day"""

CTES["funnel"] = f"""
    SELECT s.*, b.tonnage_ton AS baseline_ton, {pct("s.tonnage_ton", "b.tonnage_ton")} AS pct_of_baseline
    FROM stages s LEFT JOIN (SELECT production_date, tonnage_ton FROM stages WHERE stage_code = 'HAULING_WEIGHED') b
         USING (production_date)"""

STAGE_CODES = [s[1] for s in DEFAULTS.stages]
CTES["wide"] = "SELECT production_date, " + ", ".join(
    f"max(tonnage_ton) FILTER (WHERE stage_code = '{c}') AS {c}" for c in STAGE_CODES
) + " FROM funnel GROUP BY production_date"

CTES["gaps"] = f"""
    WITH pairs AS ({" UNION ALL ".join(
        f"SELECT production_date, '{u}' AS upstream_stage, '{d}' AS downstream_stage, '{l}' AS pair_label, "
        f"'{k}' AS gap_type, {u} AS upstream_ton, {d} AS downstream_ton FROM wide"
        for u, d, l, k in STAGE_PAIRS)}),
    diff AS (SELECT *, {rd("upstream_ton - downstream_ton", 3)} AS delta_ton FROM pairs),
    rated AS (SELECT *, {pct("delta_ton", "upstream_ton")} AS loss_pct,
                     {pct("downstream_ton", "upstream_ton")} AS recovery_pct FROM diff)
    SELECT *, CASE WHEN gap_type = 'BUFFER_CHANGE' THEN 'INFO' WHEN abs(loss_pct) >= 5 THEN 'CRITICAL'
                   WHEN abs(loss_pct) >= 2 THEN 'WARNING' WHEN loss_pct IS NULL THEN 'NO_DATA' ELSE 'NORMAL' END AS severity,
           CASE WHEN delta_ton > 0 THEN 'LOSS' WHEN delta_ton < 0 THEN 'GAIN' ELSE 'BALANCED' END AS direction
    FROM rated"""

CTES["daily"] = f"""
    SELECT production_date, month, week_start, {rd("sum(netto_ton)", 3)} AS actual_ton, count(*) AS trips,
           count(DISTINCT truck) AS active_trucks, count(DISTINCT contractor_code) AS active_contractors,
           {rd("avg(netto_ton)", 3)} AS avg_payload_ton, CAST({month_target("month")} AS DOUBLE) AS month_target_ton,
           {rd(f"{month_target('month')} / {days('production_date')}", 3)} AS target_ton
    FROM trips0 GROUP BY ALL"""

CTES["series"] = f"""
    WITH u AS (
        SELECT 'DAILY' AS grain, production_date AS period_start, production_date AS period_end,
               strftime(production_date, '%Y-%m-%d') AS period_label, actual_ton, target_ton, trips,
               CAST(active_trucks AS DOUBLE) AS active_trucks, CAST(active_contractors AS DOUBLE) AS active_contractors,
               avg_payload_ton FROM daily
        UNION ALL
        SELECT 'WEEKLY', week_start, week_start + 6, 'W' || weekofyear(week_start) || '-' || year(week_start),
               {rd("sum(actual_ton)", 3)}, {rd("sum(target_ton)", 3)}, CAST(sum(trips) AS BIGINT),
               {rd("avg(active_trucks)", 1)}, {rd("avg(active_contractors)", 1)}, {rd("avg(avg_payload_ton)", 3)}
        FROM daily GROUP BY week_start
        UNION ALL
        SELECT 'MONTHLY', CAST(month || '-01' AS DATE), last_day(CAST(month || '-01' AS DATE)), month,
               {rd("sum(actual_ton)", 3)}, max(month_target_ton), CAST(sum(trips) AS BIGINT),
               {rd("avg(active_trucks)", 1)}, {rd("avg(active_contractors)", 1)}, {rd("avg(avg_payload_ton)", 3)}
        FROM daily GROUP BY month
    ), a AS (SELECT *, {rd("actual_ton - target_ton", 3)} AS variance_ton, {pct("actual_ton", "target_ton")} AS achievement_pct FROM u)
    SELECT *, CASE WHEN achievement_pct >= 100 THEN 'ON_TARGET' WHEN achievement_pct >= 90 THEN 'AT_RISK' ELSE 'BEHIND' END AS status,
           CASE WHEN grain = 'DAILY' THEN {rd("avg(actual_ton) OVER (PARTITION BY grain ORDER BY period_start ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)", 3)} END AS ma7_actual_ton
    FROM a"""

CTES["outlook"] = f"""
    WITH b AS (
        SELECT production_date, actual_ton, strftime(production_date, '%Y-%m') AS month,
               {rd("avg(actual_ton) OVER (ORDER BY production_date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)", 3)} AS run_rate_7d,
               {rd("sum(actual_ton) OVER (PARTITION BY strftime(production_date, '%Y-%m') ORDER BY production_date ROWS UNBOUNDED PRECEDING)", 3)} AS mtd_actual_ton,
               CAST({days("production_date")} AS INTEGER) AS days_in_month, CAST(day(production_date) AS INTEGER) AS day_of_month
        FROM daily
    ), c AS (SELECT *, days_in_month - day_of_month AS days_remaining, CAST({month_target("month")} AS DOUBLE) AS month_target_ton FROM b),
    d AS (SELECT *, {rd("mtd_actual_ton + run_rate_7d * days_remaining", 3)} AS projected_month_ton FROM c),
    e AS (SELECT *, {rd("month_target_ton - projected_month_ton", 3)} AS shortfall_ton FROM d),
    f AS (SELECT *, {pct("shortfall_ton", "month_target_ton")} AS shortfall_pct,
                 CASE WHEN days_remaining > 0 THEN {rd("(month_target_ton - mtd_actual_ton) / CASE WHEN days_remaining > 0 THEN days_remaining END", 3)} END AS required_rate_ton_per_day FROM e)
    SELECT *, {rd("required_rate_ton_per_day - run_rate_7d", 3)} AS rate_gap_ton_per_day,
           CASE WHEN shortfall_ton <= 0 THEN 'ON_TRACK' WHEN shortfall_pct <= 5 THEN 'AT_RISK' ELSE 'SHORTFALL' END AS outlook_status,
           production_date = max(production_date) OVER () AS is_latest
    FROM f"""

CTES["contractors"] = f"""
    WITH c AS (
        SELECT production_date, shift, contractor_code, contractor_name, {rd("sum(netto_ton)", 3)} AS netto_ton,
               count(*) AS trips, count(DISTINCT truck) AS active_trucks, {rd("avg(netto_ton)", 3)} AS avg_payload_ton,
               quantile_disc(netto_ton, 0.5) AS median_payload_ton, {rd("avg(rom_to_port_min)", 1)} AS avg_rom_to_port_min,
               CAST(sum(CAST(is_payload_anomaly AS INTEGER)) AS BIGINT) AS payload_anomaly_trips,
               count(DISTINCT rom_code) AS rom_served, count(DISTINCT dest_code) AS dest_served
        FROM trips0 GROUP BY ALL
    ), p AS (
        SELECT c.*, {rd("CAST(trips AS DOUBLE) / active_trucks", 2)} AS trips_per_truck, l.avg_loss_pct, l.total_loss_ton, l.traced_trips
        FROM c LEFT JOIN losses l USING (production_date, shift, contractor_code)
    ), w AS (
        SELECT *, {rd("sum(netto_ton) OVER (PARTITION BY production_date)", 6)} AS day_total_ton,
               {rd("avg(avg_payload_ton) OVER (PARTITION BY production_date)", 3)} AS fleet_avg_payload_ton,
               {rd("avg(trips_per_truck) OVER (PARTITION BY production_date)", 2)} AS fleet_avg_trips_per_truck,
               CAST(row_number() OVER (PARTITION BY production_date ORDER BY netto_ton DESC NULLS LAST, contractor_code, shift) AS INTEGER) AS rank_by_ton
        FROM p
    ), g AS (
        SELECT *, {pct("netto_ton", "day_total_ton")} AS share_pct,
               {rd("(avg_payload_ton - fleet_avg_payload_ton) / fleet_avg_payload_ton * 100.0", 2)} AS deviation_vs_fleet_pct,
               {rd("(trips_per_truck - fleet_avg_trips_per_truck) / fleet_avg_trips_per_truck * 100.0", 2)} AS productivity_gap_pct
        FROM w
    )
    SELECT *, CASE WHEN productivity_gap_pct <= -15 THEN 'UNDER_UTILISED' WHEN productivity_gap_pct >= 15 THEN 'OVER_UTILISED'
                   ELSE 'BALANCED' END AS balancing_flag FROM g"""

CTES["roms"] = f"""
    WITH h AS (
        SELECT production_date, month, rom_code, {rd("sum(netto_ton)", 3)} AS hauled_ton, count(*) AS trips,
               count(DISTINCT truck) AS active_trucks, count(DISTINCT contractor_code) AS contractors,
               {rd("avg(netto_ton)", 3)} AS avg_payload_ton, {rd("avg(rom_to_port_min)", 1)} AS avg_haul_time_min,
               count(DISTINCT material_code) AS material_variants, min(client) AS primary_client
        FROM trips0 GROUP BY ALL
    ), l AS (
        SELECT production_date, rom_code, {rd("sum(tonase_ton)", 3)} AS rom_loaded_ton_urise, count(*) AS rom_load_events,
               count(DISTINCT rom_ticket_no) AS rom_tickets, count(DISTINCT loader_type) AS loader_types
        FROM loading WHERE has_tonnage GROUP BY ALL
    ), j AS (
        SELECT *, CAST({mapped("rom_code", DEFAULTS.rom_shares, "0.0")} AS DOUBLE) AS rom_share FROM h LEFT JOIN l USING (production_date, rom_code)
    ), t AS (
        SELECT *, {rd(f"CAST({month_target('month')} AS DOUBLE) * rom_share / {days('production_date')}", 3)} AS target_ton,
               {rd("rom_loaded_ton_urise - hauled_ton", 3)} AS delta_urise_vs_wim_ton FROM j
    )
    SELECT *, {pct("hauled_ton", "target_ton")} AS achievement_pct, {pct("delta_urise_vs_wim_ton", "hauled_ton")} AS delta_urise_vs_wim_pct FROM t"""

CTES["intake"] = f"""
    WITH d AS (
        SELECT production_date, shift, cp_code, {rd("sum(tonase_ton)", 3)} AS intake_ton, count(*) AS dump_events,
               count(*) FILTER (WHERE has_tonnage) AS events_with_ton, count(DISTINCT truck) AS trucks,
               {rd("sum(CASE WHEN source_leg = 'FROM_STOCKPILE' THEN tonase_ton ELSE 0 END)", 3)} AS reclaim_ton,
               {rd("sum(CASE WHEN source_leg = 'FROM_ROM_DIRECT' THEN tonase_ton ELSE 0 END)", 3)} AS direct_ton,
               {rd("avg(dwell_minutes)", 1)} AS avg_dwell_min, count(DISTINCT hour_local) AS active_hours
        FROM dumping GROUP BY ALL
    ), s AS (
        SELECT production_date, shift, dest_code AS cp_code, {rd("sum(netto_ton)", 3)} AS wim_destined_ton, count(*) AS wim_trips
        FROM trips0 WHERE dest_code LIKE 'CP-%' GROUP BY ALL
    ), j AS (
        SELECT *, replace(cp_code, 'CP-', 'CP') AS cp_name_uc06, {pct("events_with_ton", "dump_events")} AS ton_coverage_pct,
               {rd("wim_destined_ton - intake_ton", 3)} AS delta_wim_vs_cp_ton,
               {rd("intake_ton / greatest(active_hours, 1)", 2)} AS throughput_tph,
               {rd("sum(intake_ton) OVER (PARTITION BY production_date)", 6)} AS day_total_intake_ton,
               CAST(row_number() OVER (PARTITION BY production_date, shift ORDER BY intake_ton DESC NULLS LAST, cp_code) AS INTEGER) AS rank_by_intake
        FROM d LEFT JOIN s USING (production_date, shift, cp_code)
    )
    SELECT *, {pct("delta_wim_vs_cp_ton", "wim_destined_ton")} AS delta_wim_vs_cp_pct,
           {pct("intake_ton", "day_total_intake_ton")} AS share_pct FROM j"""

CTES["balance"] = f"""
    WITH h AS (
        SELECT date_trunc('hour', txn_ts_utc) AS hour_start_utc, production_date, shift, date_local, hour_local,
               {rd("sum(CASE WHEN movement = 'IN' THEN qty_ton ELSE 0 END)", 3)} AS in_ton,
               {rd("sum(CASE WHEN movement = 'OUT' THEN qty_ton ELSE 0 END)", 3)} AS out_ton,
               {rd("sum(signed_ton)", 3)} AS net_ton, count(*) FILTER (WHERE movement = 'IN') AS in_txn,
               count(*) FILTER (WHERE movement = 'OUT') AS out_txn, count(DISTINCT truck) AS distinct_trucks
        FROM ledger GROUP BY ALL
    ), a AS (SELECT avg(d) AS v FROM (SELECT sum(intake_ton) AS d FROM intake GROUP BY production_date)),
    b AS (
        SELECT h.*, {rd("sum(net_ton) OVER (ORDER BY hour_start_utc ROWS UNBOUNDED PRECEDING)", 3)} AS balance_ton,
               (SELECT v FROM a) AS v FROM h
    ), c AS (SELECT * EXCLUDE (v), {rd("v", 3)} AS avg_daily_cp_ton, {rd("balance_ton / v", 2)} AS days_of_cover FROM b)
    SELECT *, CASE WHEN days_of_cover IS NULL THEN 'UNKNOWN' WHEN days_of_cover < 1.5 THEN 'LOW'
                   WHEN days_of_cover < 3.0 THEN 'ADEQUATE' ELSE 'HEALTHY' END AS buffer_status,
           TRUE AS is_relative_balance FROM c"""

CTES["anomalies"] = f"""
    WITH s AS (
        SELECT production_date, 'STAGE' AS dimension, pair_label AS dimension_value, loss_pct AS metric_value,
               delta_ton AS loss_ton, upstream_ton AS reference_ton
        FROM gaps WHERE gap_type <> 'BUFFER_CHANGE' AND loss_pct IS NOT NULL
        UNION ALL
        SELECT production_date, 'CONTRACTOR', contractor_name, {rd("avg(avg_loss_pct)", 2)}, {rd("sum(total_loss_ton)", 3)}, {rd("sum(netto_ton)", 3)}
        FROM contractors WHERE avg_loss_pct IS NOT NULL GROUP BY production_date, contractor_name
        UNION ALL
        SELECT production_date, 'ROM', rom_code, delta_urise_vs_wim_pct, delta_urise_vs_wim_ton, hauled_ton
        FROM roms WHERE delta_urise_vs_wim_pct IS NOT NULL
    ), m AS (SELECT *, quantile_disc(metric_value, 0.5) OVER (PARTITION BY dimension, dimension_value) AS baseline_median_pct FROM s),
    d AS (SELECT *, quantile_disc(abs(metric_value - baseline_median_pct), 0.5) OVER (PARTITION BY dimension, dimension_value) AS mad_pct FROM m),
    z AS (SELECT *, CASE WHEN mad_pct > 0 THEN {rd("0.6745 * (metric_value - baseline_median_pct) / CASE WHEN mad_pct > 0 THEN mad_pct END", 2)} ELSE 0.0 END AS robust_z FROM d)
    SELECT *, abs(robust_z) >= 3 AS is_anomaly,
           CASE WHEN abs(robust_z) >= 3 * 1.67 THEN 'CRITICAL' WHEN abs(robust_z) >= 3 THEN 'HIGH'
                WHEN abs(metric_value) >= 5 THEN 'MEDIUM' ELSE 'LOW' END AS severity FROM z"""

CTES["kpis"] = f"""
    WITH ops AS (
        SELECT production_date, count(*) AS total_trips, count(DISTINCT truck) AS active_trucks,
               count(DISTINCT contractor_code) AS active_contractors, {rd("avg(netto_ton)", 3)} AS avg_payload_ton,
               {rd("avg(rom_to_port_min)", 1)} AS avg_cycle_min,
               CAST(sum(CAST(is_payload_anomaly AS INTEGER)) AS BIGINT) AS payload_anomaly_trips
        FROM trips0 GROUP BY ALL
    ), trace AS (
        SELECT production_date, {rd("avg(CAST(is_matched_cp AS INTEGER)) * 100", 1)} AS cp_trace_rate_pct,
               {rd("avg(CAST(is_matched_rom AS INTEGER)) * 100", 1)} AS rom_trace_rate_pct,
               {rd("sum(delta_wim_vs_cp_ton)", 3)} AS traced_loss_ton FROM trips GROUP BY ALL
    ), closing AS (
        SELECT production_date, balance_ton AS closing_stock_ton, days_of_cover, buffer_status FROM balance
        QUALIFY row_number() OVER (PARTITION BY production_date ORDER BY hour_start_utc DESC) = 1
    ), anom AS (
        SELECT production_date, count(*) FILTER (WHERE is_anomaly) AS anomaly_count,
               count(*) FILTER (WHERE severity = 'CRITICAL') AS critical_anomalies FROM anomalies GROUP BY ALL
    )
    SELECT w.production_date, w.ROM_PRODUCTION AS rom_production_ton, w.HAULING_WEIGHED AS hauling_ton,
           w.HAULING_DIRECT_CP AS direct_cp_ton, w.STOCKPILE_IN AS stockpile_in_ton, w.STOCKPILE_OUT AS stockpile_out_ton,
           w.CP_INTAKE AS cp_intake_ton, w.SHIPMENT AS shipment_ton,
           ops.* EXCLUDE (production_date), trace.* EXCLUDE (production_date), closing.* EXCLUDE (production_date),
           anom.* EXCLUDE (production_date), o.run_rate_7d, o.projected_month_ton, o.month_target_ton, o.shortfall_ton, o.outlook_status,
           {pct("w.CP_INTAKE", "w.HAULING_WEIGHED")} AS end_to_end_recovery_pct,
           {rd("w.HAULING_WEIGHED - w.CP_INTAKE", 3)} AS end_to_end_loss_ton,
           {pct("w.HAULING_DIRECT_CP", "w.HAULING_WEIGHED")} AS direct_share_pct,
           {rd(f"w.HAULING_WEIGHED / (o.month_target_ton / {days('w.production_date')}) * 100.0", 2)} AS achievement_pct
    FROM wide w LEFT JOIN ops USING (production_date) LEFT JOIN trace USING (production_date)
         LEFT JOIN closing USING (production_date) LEFT JOIN anom USING (production_date)
         LEFT JOIN outlook o USING (production_date)"""


def candidate(code: str, category: str, entity: str, severity: str, gain: str, source: str) -> str:
    return f"""
    SELECT production_date, '{code}' AS candidate_code, '{category}' AS category, {entity} AS entity,
           coalesce({rd(severity, 2)}, 0.0) AS severity_score, coalesce({rd(gain, 1)}, 0.0) AS expected_gain_ton
    FROM {source}"""


CTES["candidates"] = f"""
    WITH r1 AS (
        SELECT production_date, contractor_name, {rd("avg(productivity_gap_pct)", 2)} AS gap_pct, {rd("avg(trips_per_truck)", 2)} AS tpt,
               {rd("avg(fleet_avg_trips_per_truck)", 2)} AS fleet, max(active_trucks) AS n, {rd("avg(avg_payload_ton)", 2)} AS payload
        FROM contractors WHERE balancing_flag = 'UNDER_UTILISED' GROUP BY ALL
    ), r2 AS (
        SELECT production_date, contractor_name, {rd("avg(deviation_vs_fleet_pct)", 2)} AS dev, {rd("avg(avg_payload_ton)", 2)} AS payload,
               {rd("avg(fleet_avg_payload_ton)", 2)} AS fleet, sum(trips) AS trips
        FROM contractors WHERE deviation_vs_fleet_pct <= -5 GROUP BY ALL
    ), r6 AS (
        SELECT production_date, min(days_of_cover) AS cover, {rd("max(avg_daily_cp_ton)", 1)} AS avg_cp
        FROM balance GROUP BY ALL HAVING min(days_of_cover) < 1.5
    ), r7a AS (SELECT production_date, cp_code, {rd("sum(intake_ton)", 1)} AS ton FROM intake GROUP BY ALL),
    r7b AS (
        SELECT *, max(ton) OVER w AS hi, min(ton) OVER w AS lo, {rd("avg(ton) OVER (PARTITION BY production_date)", 1)} AS mid
        FROM r7a WINDOW w AS (PARTITION BY production_date)
    ), r7 AS (SELECT *, {rd("hi / greatest(lo, 1.0)", 2)} AS ratio FROM r7b),
    found AS (
        {candidate("CONTRACTOR_BALANCING", "BALANCING", "contractor_name", "abs(gap_pct)", "greatest(fleet - tpt, 0.0) * n * payload", "r1")}
        UNION ALL {candidate("PAYLOAD_UNDERLOAD", "BALANCING", "contractor_name", "abs(dev)", "(fleet - payload) * trips", "r2")}
        UNION ALL {candidate("ABNORMAL_LOSS", "LOSS", "dimension || ': ' || dimension_value", "abs(robust_z) * 10.0", "abs(loss_ton) * 0.5", "anomalies WHERE is_anomaly")}
        UNION ALL {candidate("STAGE_LOSS", "LOSS", "pair_label", "abs(loss_pct) * 5.0", "abs(delta_ton)", "gaps WHERE severity IN ('WARNING', 'CRITICAL')")}
        UNION ALL {candidate("SHIPMENT_SHORTFALL", "SHIPMENT", "'Month target ' || month", "least(coalesce(shortfall_pct, 0.0) * 4.0, 100.0)", "shortfall_ton", "outlook WHERE outlook_status <> 'ON_TRACK'")}
        UNION ALL {candidate("STOCKPILE_BUFFER", "STOCKPILE", "'NORTH-STOCKPILE'", "(1.5 - cover) * 30.0", "(1.5 - cover) * avg_cp", "r6")}
        UNION ALL {candidate("CP_IMBALANCE", "THROUGHPUT", "cp_code", "least(ratio * 8.0, 100.0)", "mid - ton", "r7 WHERE ratio > 3 AND ton = lo")}
        UNION ALL {candidate("TRACEABILITY_GAP", "DATA_QUALITY", "'Trip tracing WIM -> CP'", "100.0 - cp_trace_rate_pct", "end_to_end_loss_ton", "kpis WHERE cp_trace_rate_pct < 80")}
    ), scored AS (
        SELECT *, CASE WHEN max(expected_gain_ton) OVER w > 0
                       THEN {rd("expected_gain_ton / CASE WHEN max(expected_gain_ton) OVER (PARTITION BY production_date) > 0 THEN max(expected_gain_ton) OVER (PARTITION BY production_date) END * 100.0", 2)}
                       ELSE 0.0 END AS impact_score
        FROM found WHERE production_date IS NOT NULL WINDOW w AS (PARTITION BY production_date)
    ), prio AS (SELECT *, {rd("severity_score * 0.5 + impact_score * 0.5", 2)} AS priority_score FROM scored)
    SELECT *, CAST(row_number() OVER (PARTITION BY production_date ORDER BY priority_score DESC, expected_gain_ton DESC, candidate_code, entity) AS INTEGER) AS candidate_rank
    FROM prio"""


def compose(final: str, extra: dict[str, str] | None = None) -> str:
    """``WITH`` clause holding exactly the CTEs the final statement needs."""
    known = CTES | (extra or {})
    needed: list[str] = []

    def visit(body: str) -> None:
        for name in known:
            if re.search(rf"\b(?:FROM|JOIN)\s+{name}\b", body) and name not in needed and known[name] is not body:
                visit(known[name])
                if name not in needed:
                    needed.append(name)

    visit(final)
    clauses = ",\n".join(f"{n} AS MATERIALIZED ({known[n]})" for n in needed)
    if not needed:
        return final
    own = re.match(r"\s*WITH\b", final)
    return f"WITH {clauses},\n{final[own.end():]}" if own else f"WITH {clauses}\n{final}"


CTES["readings"] = f"""
    WITH raw AS (
        SELECT DISTINCT {pick(PLACES, f"user_id % {len(PLACES)}")} AS location, date_trunc('minute', ts) AS moment,
               ts + to_minutes(again) AS received, CASE WHEN event_id % 17 <> 0 THEN kg + again * 10 END AS today, kg
        FROM (SELECT *, unnest(CASE WHEN event_id % 10 = 0 THEN [0, 1] ELSE [0] END) AS again FROM ev)
    ), latest AS (
        SELECT * FROM raw QUALIFY row_number() OVER (
            PARTITION BY location, moment ORDER BY received DESC, today DESC NULLS LAST, kg DESC) = 1
    ), d AS (
        SELECT *, date_diff('second', lag(moment) OVER w, moment) AS time_delta_seconds,
               CASE WHEN today >= lag(today) OVER w THEN CAST(today - lag(today) OVER w AS DOUBLE) END AS delta_volume
        FROM latest WINDOW w AS (PARTITION BY location ORDER BY moment)
    ), t AS (SELECT *, {rd("delta_volume * 0.88", 4)} AS tonnage_delta, {rd("today * 0.88", 2)} AS tonnage_total_today FROM d)
    SELECT location, moment AS timestamp_data_ts, CAST(today AS DOUBLE) AS totalizer_today, time_delta_seconds, delta_volume,
           tonnage_delta, tonnage_total_today,
           CASE WHEN time_delta_seconds > 0 THEN {rd("tonnage_delta / (CASE WHEN time_delta_seconds > 0 THEN time_delta_seconds END / 3600.0)", 2)} END AS throughput_tph,
           CASE WHEN location IN ('CV14', 'CV22') THEN 'direct' WHEN location IN ('CV15A', 'CV23B') THEN 'non_direct'
                WHEN location LIKE 'CP%' THEN 'cp_output' ELSE 'other' END AS flow_mode,
           CASE WHEN location LIKE 'CP%' THEN location WHEN location = 'CV14' THEN 'CP1' WHEN location = 'CV22' THEN 'CP6' END AS linked_cp,
           location LIKE 'CP%' AS is_cp, location LIKE 'CV%' AS is_cv,
           CASE WHEN hour(moment) BETWEEN 6 AND 17 THEN 'Pagi' ELSE 'Malam' END AS shift,
           CAST(moment - INTERVAL 6 HOUR AS DATE) AS adjusted_date
    FROM t"""

CTES["plant_out"] = f"""
    SELECT location AS cp_name, adjusted_date, shift, count(*) AS reading_count, {rd("sum(delta_volume)", 2)} AS total_volume,
           {rd("sum(tonnage_delta)", 2)} AS total_tonnage, {rd("avg(delta_volume)", 2)} AS avg_volume_per_reading,
           {rd("avg(tonnage_delta)", 2)} AS avg_tonnage_per_reading, max(tonnage_total_today) AS totalizer_tonnage_eod,
           {rd("avg(throughput_tph)", 2)} AS avg_throughput_tph, min(timestamp_data_ts) AS first_reading,
           max(timestamp_data_ts) AS last_reading,
           {rd("date_diff('second', min(timestamp_data_ts), max(timestamp_data_ts)) / 3600.0", 2)} AS duration_hours
    FROM readings WHERE is_cp AND tonnage_delta IS NOT NULL GROUP BY ALL"""

PLANTS = {str(k): v for k, v in DEFAULTS.plants.items()}
CTES["running"] = f"""
    WITH s AS (
        SELECT {mapped("CAST(user_id % 12 + 1 AS VARCHAR)", PLANTS, "'CP' || (user_id % 12 + 1)")} AS cp_number,
               CAST(ts AS DATE) AS event_date, CAST(ts - INTERVAL 6 HOUR AS DATE) AS adjusted_date,
               CASE WHEN hour(ts) BETWEEN 6 AND 17 THEN 'Pagi' ELSE 'Malam' END AS shift,
               CASE event_id % 5 WHEN 0 THEN 'chain_feeder' WHEN 1 THEN 'feeder_breaker' WHEN 2 THEN 'crusher'
                                 WHEN 3 THEN 'conveyor' ELSE 'other' END AS equipment_category,
               event_id % 3 <> 2 AS is_running
        FROM ev
    ), a AS (
        SELECT cp_number, adjusted_date AS event_date, shift, equipment_category, count(*) AS total_readings,
               count(*) FILTER (WHERE is_running) AS running_readings FROM s GROUP BY ALL
    ), h AS (
        SELECT *, {rd("running_readings * 30.0 / 3600.0", 2)} AS running_hours_est, {pct("running_readings", "total_readings")} AS running_pct FROM a
    )
    SELECT *, {rd("running_hours_est / 12.0 * 100", 2)} AS utilization FROM h"""

CTES["belt_days"] = f"""
    WITH w AS (
        SELECT CAST(ts + INTERVAL 8 HOUR AS DATE) AS date, {rd("sum(kg / 1000.0)", 2)} AS wim_tonnage, count(*) AS truck_count,
               {rd("avg(kg / 1000.0)", 2)} AS avg_netto_per_truck
        FROM ev WHERE event_type = 'purchase' AND event_id % 50 <> 0 GROUP BY ALL
    ), c AS (
        SELECT adjusted_date AS date, {rd("sum(tonnage_delta)", 2)} AS conveyor_tonnage, {rd("sum(delta_volume)", 2)} AS conveyor_volume,
               count(*) AS cv_reading_count
        FROM readings WHERE is_cv AND tonnage_delta IS NOT NULL GROUP BY ALL
    ), j AS (
        SELECT *, {rd("wim_tonnage / CASE WHEN conveyor_tonnage <> 0 THEN conveyor_tonnage END", 4)} AS wim_cv_ratio FROM w JOIN c USING (date)
    )
    SELECT *, {rd("(wim_cv_ratio - 1.0) * 100", 2)} AS deviation_pct,
           coalesce({rd("abs(wim_cv_ratio - 1.0)", 6)} > 0.05, FALSE) AS anomaly_flag,
           CASE WHEN wim_cv_ratio > 1.05 THEN 'WIM_OVER' WHEN wim_cv_ratio < 0.95 THEN 'CV_OVER' ELSE 'NORMAL' END AS anomaly_type,
           CASE WHEN conveyor_volume > 0 THEN {rd("wim_tonnage / CASE WHEN conveyor_volume > 0 THEN conveyor_volume END", 4)} END AS density_actual
    FROM j"""

CTES["queue"] = """
    WITH raw AS (
        SELECT l_orderkey * 10 + l_linenumber AS n, l.*, o.o_orderstatus, o.o_orderpriority,
               o.o_orderdate + to_minutes((l_orderkey * 10 + l_linenumber) % 1440) AS start
        FROM lineitem l JOIN orders o ON l_orderkey = o_orderkey
    ), t AS (
        SELECT *, start + to_minutes(n % 97 - 5) AS gone, 
                  -- Two-digit years are read as 20xx.
                  start + to_minutes(n % 33) + CASE WHEN year(start + to_minutes(n % 33)) < 2000 THEN INTERVAL 100 YEAR ELSE INTERVAL 0 YEAR END AS antri FROM raw
    ), v AS (
        SELECT CASE WHEN n % 83 <> 0 THEN n END AS assignment_id_value, CASE WHEN n % 71 <> 0 THEN l_suppkey END AS truck_id_value,
               CAST(l_linenumber AS BIGINT) AS lane_id_value, 'LANE ' || l_linenumber AS lane_sb,
               1000.0 + CAST(l_quantity AS INTEGER) AS tonnage_value, 'CP' || (l_partkey % 9 + 1) AS queue_name,
               l_returnflag AS port, l_linestatus AS truck_type,
               CASE o_orderstatus WHEN 'F' THEN 'COMPLETED' WHEN 'O' THEN 'OPEN' END AS status, 'T' || l_suppkey AS nomor_lambung,
               o_orderpriority AS assigned_by, n % 3 = 0 AS is_anomaly_bool,
               CASE WHEN n % 29 = 0 THEN TRUE END AS is_anomaly_queue_lane_bool, start AS created_at_ts,
               CASE WHEN n % 19 <> 0 THEN start WHEN n % 5 <> 0 THEN start END AS vehicle_in_time_ts,
               CASE WHEN n % 13 <> 0 THEN gone ELSE gone + INTERVAL 376713 MICROSECOND END AS vehicle_out_time_ts,
               antri, start, gone, n
        FROM t
    )
    SELECT *, CAST(created_at_ts AS DATE) AS transaction_date, CAST(hour(created_at_ts) AS INTEGER) AS transaction_hour,
           CASE WHEN vehicle_in_time_ts IS NOT NULL THEN 'IN_OUT_COMPLETED' ELSE 'OUT_WITHOUT_IN' END AS vehicle_movement_status,
           CASE WHEN antri >= start THEN date_diff('second', start, antri) / 60.0 END AS queue_duration_minutes,
           CASE WHEN vehicle_out_time_ts >= vehicle_in_time_ts
                THEN (epoch(date_trunc('second', vehicle_out_time_ts)) - epoch(vehicle_in_time_ts)) / 60.0 END AS cp_area_duration_minutes,
           CASE WHEN n % 5 <> 0 AND gone + INTERVAL 376713 MICROSECOND >= start
                THEN (epoch(gone) - epoch(start)) / 60.0 END AS cp_process_duration_minutes,
           CASE WHEN assignment_id_value IS NULL THEN 'missing_assignment_id' WHEN truck_id_value IS NULL THEN 'missing_truck_id'
                WHEN vehicle_in_time_ts IS NULL THEN 'missing_vehicle_in_time' WHEN status IS NULL THEN 'missing_status'
                ELSE 'valid' END AS data_quality_status
    FROM v"""
