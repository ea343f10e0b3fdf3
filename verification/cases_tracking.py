"""Positions: lanes, spacing, rollups, map data; and the streaming forms of them."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tonflow.functions import geo
from tonflow.operators import quality, spatial, tables
from tonflow.plans import speed, tracking
from tonflow.sources.session import cut_lineage, shared_folder
from tonflow.streaming import live, watch
from verification import inputs
from verification.cases_haulage import BAND, CLOSING
from verification.ctes import CODES, pick, rd
from verification.registry import case

R = "6371000.0"


def haversine(lat1: str, lon1: str, lat2: str, lon2: str) -> str:
    a = (
        f"pow(sin(radians({lat2} - {lat1}) / 2), 2) + cos(radians({lat1})) * cos(radians({lat2})) "
        f"* pow(sin(radians({lon2} - {lon1}) / 2), 2)"
    )
    return f"2 * {R} * asin(sqrt(least({a}, 1.0)))"


GEO = {
    "pos": """
        SELECT event_id AS id, user_id AS deviceid,
               TIMESTAMP '2024-01-01 05:30:00' + to_seconds(CAST(epoch(ts) AS BIGINT) % 3600) AS devicetime, ts AS servertime,
               -3.5 + (event_id % 1000) * 0.0001::DOUBLE AS latitude,
               115.0 + (user_id % 13) * 0.0002::DOUBLE + CASE WHEN event_id % 3 = 0 THEN 0.0001::DOUBLE ELSE 0.0 END AS longitude,
               kg % 400 / 10.0 AS speed, CAST((user_id * 45 + event_id % 7) % 361 AS DOUBLE) AS course,
               ['[0,1]', '[2]', '[]', '[a, 3]'][CAST(event_id % 4 AS INTEGER) + 1] AS geofenceids, event_id % 37 <> 0 AS ok,
               'road ' || (event_id % 5) AS address FROM ev""",
    "dev": f"""
        SELECT c_custkey AS id, {pick(CODES, f"c_custkey % {len(CODES)}")} || ' ' || c_custkey AS name,
               ['online', 'offline', 'unknown'][CAST(c_custkey % 3 AS INTEGER) + 1] AS status, c_mktsegment AS category
        FROM customer WHERE c_custkey % 11 <> 0""",
    "road": """
        SELECT CAST(n_nationkey AS VARCHAR) AS lane_id, n_name AS jalur, CASE WHEN (n_nationkey // 2) % 2 = 0 THEN 'MUATAN' ELSE 'KOSONGAN' END AS jalur_arah,
               115.0 + (n_nationkey // 2) * 0.0002::DOUBLE AS lane_lon, s.a AS lat_a, s.b AS lat_b
        FROM nation, (VALUES (-3.5::DOUBLE, -3.45::DOUBLE), (-3.45::DOUBLE, -3.4::DOUBLE)) s(a, b)""",
    "near": f"""
        SELECT p.*, lane_id, jalur, jalur_arah, min({haversine("p.latitude", "p.longitude", "greatest(lat_a, least(lat_b, p.latitude))", "lane_lon")}) AS dist
        FROM pos p JOIN road ON abs(p.longitude - lane_lon) < 0.00006 WHERE p.ok GROUP BY ALL HAVING dist <= 4.4""",
    "located": """
        SELECT n.* EXCLUDE (dist), coalesce(d.name, CAST(n.deviceid AS VARCHAR)) AS truk,
               CASE WHEN course BETWEEN 0 AND 90 OR course BETWEEN 270 AND 360 THEN 'utara' WHEN course BETWEEN 90 AND 270 THEN 'selatan' END AS grup_arah,
               time_bucket(INTERVAL 5 SECOND, devicetime) AS w,
               CASE WHEN course = 90 THEN longitude WHEN course = 270 THEN -longitude WHEN course BETWEEN 90 AND 270 THEN -latitude ELSE latitude END AS k1,
               CASE WHEN course <= 180 THEN longitude ELSE -longitude END AS k2
        FROM near n LEFT JOIN dev d ON n.deviceid = d.id QUALIFY row_number() OVER (PARTITION BY n.id ORDER BY jalur) = 1""",
    "last_of_truck": """
        SELECT * FROM located QUALIFY row_number() OVER (PARTITION BY w, jalur_arah, truk ORDER BY devicetime DESC, id DESC) = 1""",
    "queued": """
        SELECT *, lead(truk) OVER q AS truk_depan, lead(id) OVER q AS id2, lead(latitude) OVER q AS lat2, lead(longitude) OVER q AS lon2,
               lead(speed) OVER q AS speed2, lead(jalur) OVER q AS jalur2
        FROM located WINDOW q AS (PARTITION BY w, jalur_arah ORDER BY k1 NULLS FIRST, k2 NULLS FIRST, truk, id)""",
    "pairs": f"""
        SELECT truk, truk_depan, CASE WHEN jalur <> jalur2 THEN 'Beda Jalur' ELSE 'Sejalur' END AS sejalur, jalur, jalur2,
               round(gap, 0) AS jarak,
               CASE WHEN speed > speed2 THEN round(gap / CASE WHEN speed > speed2 THEN (speed - speed2) * 1.852::DOUBLE * (1000.0::DOUBLE / 3600.0::DOUBLE) END, 0) END AS jarak_waktu,
               speed, speed2, devicetime, grup_arah, CAST(id AS VARCHAR) AS truk_id, CAST(id2 AS VARCHAR) AS truk_depan_id,
               trim(substr(trim(truk), 1, 4)) AS grup_truk, geofenceids, w
        FROM (SELECT *, {haversine("latitude", "longitude", "lat2", "lon2")} AS gap FROM queued WHERE truk_depan IS NOT NULL)""",
    "fenced": """
        SELECT p.*, f.name AS geofence_name FROM (
            SELECT *, unnest(CASE geofenceids WHEN '[0,1]' THEN [0, 1] WHEN '[2]' THEN [2] WHEN '[a, 3]' THEN [3] ELSE [] END) AS fence FROM pairs) p
        JOIN (SELECT r_regionkey, 'KM ' || CAST(r_regionkey * 1.5::DOUBLE AS VARCHAR) || ' ' || r_name AS name FROM region) f ON p.fence = f.r_regionkey""",
}


def geo_case(name: str, sql: str, **extra: str):
    return case(name, sql, **(GEO | extra))


@geo_case("haversine", f"SELECT id, {rd(haversine('latitude', 'longitude', '-3.45::DOUBLE', '115.001::DOUBLE'), 3)} AS metres FROM pos")
def haversine_query(spark, d):
    metres = geo.haversine_m("latitude", "longitude", F.lit(-3.45), F.lit(115.001))
    return inputs.positions(spark, d).select("id", F.round(F.round(metres, 9), 3).alias("metres"))


@geo_case("lane_match", f"SELECT id, lane_id, jalur, {rd('dist', 3)} AS metres FROM near QUALIFY row_number() OVER (PARTITION BY id ORDER BY jalur) = 1")
def lane_match(spark, d):
    points = tracking.valid_positions(inputs.positions(spark, d)).select("id", "latitude", "longitude")
    cells = spatial.lane_cells(tracking.lane_table(inputs.lanes(spark, d)), "koordinat_jalur")
    near = spatial.near_lanes(points, cells, "latitude", "longitude")
    one = spatial.one_lane_each(near, ["id"], "jalur", ["lane_id", "jalur"])
    return one.select("id", "lane_id", "jalur", F.round(F.round("lane_dist_m", 9), 3).alias("metres"))


LAST = {"queued": GEO["queued"].replace("FROM located WINDOW", "FROM last_of_truck WINDOW")}


def spacing(spark, d, fences: bool = True, one_per_truck: bool = False):
    return tracking.vehicle_spacing(
        inputs.positions(spark, d), inputs.devices(spark, d), inputs.lanes(spark, d),
        inputs.geofences(spark, d) if fences else None, one_per_truck,
    )


PAIR_COLUMNS = [
    "truk", "truk_depan", "sejalur", "jalur", "jalur2", "jarak", "jarak_waktu", "speed", "speed2", "devicetime",
    "grup_arah", "truk_id", "truk_depan_id", "grup_truk", "geofenceids",
]


@geo_case("truck_pairs", f"SELECT {', '.join(PAIR_COLUMNS)} FROM pairs")
def truck_pairs(spark, d):
    return spacing(spark, d, fences=False).select(*PAIR_COLUMNS)


@geo_case("truck_pairs_last", f"SELECT {', '.join(PAIR_COLUMNS)} FROM pairs", **LAST)
def truck_pairs_last(spark, d):
    """Only a truck's last position of a window counts."""
    return spacing(spark, d, fences=False, one_per_truck=True).select(*PAIR_COLUMNS)


@geo_case("vehicle_spacing", f"SELECT {', '.join(PAIR_COLUMNS)}, geofence_name FROM fenced")
def vehicle_spacing(spark, d):
    return spacing(spark, d).select(*PAIR_COLUMNS, "geofence_name")


# --- rollups over ready-made spacing rows -------------------------------------------

ROWS = """
    SELECT CASE WHEN event_id % 90 <> 0 THEN ts END AS devicetime,
           CASE WHEN event_id % 4 <> 0 THEN CAST(event_id % 20 / 2.0::DOUBLE AS VARCHAR) ELSE '' END AS KM,
           substr(unit, 1, 3) AS grup_truk_name, round(value, 0) AS jarak, CASE WHEN event_id % 5 <> 0 THEN round(value * 2, 0) END AS jarak_waktu
    FROM ev"""
LABELLED = """
    SELECT *, CASE CAST(hour(devicetime) AS INTEGER) // 6 WHEN 0 THEN '00:00-05:59' WHEN 1 THEN '06:00-11:59' WHEN 2 THEN '12:00-17:59' WHEN 3 THEN '18:00-23:59' ELSE 'Unknown' END AS Interval,
           coalesce(['Minggu', 'Senin', 'Selasa', 'Rabu', 'Kamis', 'Jumat', 'Sabtu'][CAST(dayofweek(devicetime) AS INTEGER) + 1], 'Unknown') AS Hari,
           year(devicetime) || '-W' || lpad(CAST(weekofyear(devicetime) AS VARCHAR), 2, '0') AS week_of_year,
           time_bucket(INTERVAL 5 MINUTE, devicetime) AS window_start
    FROM spaced"""
ROLLUP = dict(spaced=ROWS, labelled=LABELLED)


def means(*names: str) -> str:
    return ", ".join(f"{rd(f'avg({n})', 6)} AS rerata_{n}" for n in names)


def labelled(spark, d):
    return tracking.with_labels(inputs.spacing_rows(spark, d), "Unknown")


for _kind, _keys, _measures, _where in (
    ("gps", "Interval, Hari, week_of_year", ("jarak_waktu", "jarak"), "TRUE"),
    ("km", "KM, Hari, week_of_year", ("jarak_waktu",), "KM <> ''"),
    ("group", "grup_truk_name, Hari, week_of_year", ("jarak_waktu",), "TRUE"),
):

    @case(f"spacing_overall_{_kind}", f"SELECT {_keys}, {means(*_measures)} FROM labelled WHERE {_where} GROUP BY ALL", **ROLLUP)
    def _overall(spark, d, kind=_kind):
        return tracking.overall_rollup(labelled(spark, d), kind)

    @case(
        f"spacing_windows_{_kind}",
        f"""SELECT window_start, window_start + INTERVAL 5 MINUTE AS window_end, {_keys}, {means(*_measures)}
            FROM labelled WHERE {_where} AND devicetime IS NOT NULL GROUP BY ALL""",
        **ROLLUP,
    )
    def _windows(spark, d, kind=_kind):
        return tracking.windowed_rollup(labelled(spark, d), kind)


# --- map data -----------------------------------------------------------------------


@geo_case(
    "latest_positions",
    """SELECT d.id AS device_id, name AS device_name, status, category, latitude, longitude, speed, servertime AS last_update, address,
              CASE status WHEN 'online' THEN '#00FF00' WHEN 'offline' THEN '#FF0000' ELSE '#FFFF00' END AS color_hex
       FROM dev d JOIN (SELECT * FROM pos QUALIFY row_number() OVER (PARTITION BY deviceid ORDER BY servertime DESC, id DESC) = 1) p ON d.id = p.deviceid""",
)
def latest_positions(spark, d):
    return tracking.latest_positions(inputs.positions(spark, d), inputs.devices(spark, d))


_CORNER = {
    "square": """
        SELECT CAST(r_regionkey AS BIGINT) AS id, 'KM ' || CAST(r_regionkey * 1.5::DOUBLE AS VARCHAR) || ' ' || r_name AS name,
               round(-3.5 + r_regionkey * 0.01, 3)::DOUBLE AS lat, round(115.0 + r_regionkey * 0.01, 3)::DOUBLE AS lon,
               round(-3.5 + r_regionkey * 0.01 + 0.005, 3)::DOUBLE AS lat2, round(115.0 + r_regionkey * 0.01 + 0.005, 3)::DOUBLE AS lon2
        FROM region WHERE r_regionkey <> 4"""
}
_FEATURE = """'{"type":"Feature","properties":{"id":' || id || ',"name":"' || name || '","description":""},"geometry":{"type":"Polygon","coordinates":[[[' ||
    lon || ',' || lat || '],[' || lon2 || ',' || lat || '],[' || lon2 || ',' || lat2 || '],[' || lon || ',' || lat || ']]]}}'"""


@case("geofence_features", f"SELECT id, {_FEATURE} AS feature FROM square", **_CORNER)
def geofence_features(spark, d):
    return tracking.geofence_features(tracking.geofence_polygons(inputs.geofences(spark, d)))


@case(
    "feature_collections",
    f"""SELECT id % 2 AS tile, '{{"type":"FeatureCollection","features":[' || string_agg({_FEATURE}, ',' ORDER BY id) || ']}}' AS collection
        FROM square GROUP BY ALL""",
    **_CORNER,
)
def feature_collections(spark, d):
    return tracking.feature_collections(geofence_features(spark, d), F.col("id") % 2)


TILE_BYTES = 20_000


@case(
    "map_documents",
    f"""WITH f AS (SELECT o_orderkey AS id, '{{"type":"Feature","id":' || o_orderkey || ',"properties":{{"status":"' || o_orderstatus || '"}}}}' AS feature,
                      CAST(floor((115.0::DOUBLE + (o_orderkey % 100) * 0.0005::DOUBLE + 180.0) / 360.0 * 262144.0) AS BIGINT) AS x,
                      CAST(floor((-3.5::DOUBLE + (o_custkey % 10) * (o_custkey % 10) * 0.001::DOUBLE + 90.0) / 180.0 * 262144.0) AS BIGINT) AS y FROM orders),
        b AS (SELECT *, length(feature) + 1 AS bytes FROM f),
        l AS (SELECT level, x >> (18 - level) AS tx, y >> (18 - level) AS ty, sum(bytes) AS total FROM b, (SELECT CAST(unnest(range(19)) AS INTEGER) AS level) GROUP BY ALL),
        t AS (SELECT id, feature, bytes, arg_min(level || '/' || tx || '/' || ty, level) AS tile FROM b JOIN l
              ON tx = x >> (18 - level) AND ty = y >> (18 - level) AND (total <= {TILE_BYTES} OR level = 18) GROUP BY id, feature, bytes),
        d AS (SELECT *, CAST((sum(bytes) OVER (PARTITION BY tile ORDER BY id) - bytes) // {TILE_BYTES} AS BIGINT) AS document FROM t)
        SELECT tile, document, count(*) AS features, '{{"type":"FeatureCollection","features":[' || string_agg(feature, ',' ORDER BY id) || ']}}' AS collection
        FROM d GROUP BY tile, document""",
)
def map_documents(spark, d):
    """Orders as points on a map, in documents of bounded size."""
    o = inputs.table(spark, d, "orders")
    feature = F.concat(F.lit('{"type":"Feature","id":'), F.col("o_orderkey").cast("string"), F.lit(',"properties":{"status":"'), "o_orderstatus", F.lit('"}}'))
    points = o.select(
        F.col("o_orderkey").alias("id"), feature.alias("feature"), (F.lit(115.0) + (F.col("o_orderkey") % 100) * F.lit(0.0005)).alias("lon"),
        (F.lit(-3.5) + (F.col("o_custkey") % 10) * (F.col("o_custkey") % 10) * F.lit(0.001)).alias("lat"),
    )
    return tracking.map_documents(points, "lon", "lat", TILE_BYTES)


# --- streaming ----------------------------------------------------------------------


def drained(query_of, spark):
    """Run a stream over what is there now and give back what it wrote."""
    folder = shared_folder(spark)
    query_of(f"{folder}/out", f"{folder}/state").awaitTermination()
    return spark.read.parquet(f"{folder}/out")


def event_stream(spark, d):
    """The events file as a growing folder of files."""
    schema = inputs.table(spark, d, "events").schema
    reader = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet")
    return reader.parquet(d)


@case(
    "stream_closing_speed",
    f"""SELECT event_id AS id, {BAND} AS speed_category, CAST(timestamp_in AS DATE) AS date, company_code_standard FROM closing""",
    closing=CLOSING,
)
def stream_closing_speed(spark, d):
    raw = inputs.closings_of(event_stream(spark, d))
    silver = live.speed_stream(raw).select("id", "speed_category", "date", "company_code_standard")
    return drained(lambda out, state: live.to_files(silver, out, state), spark)


@case(
    "stream_daily_speed",
    f"""SELECT strftime(timestamp_in, '%Y-%m-%d') AS tanggal, {BAND} AS kecepatan, count(truck) AS jumlah_transaksi
        FROM closing WHERE status_trx_wim = 'ACTUAL' AND average_speed IS NOT NULL GROUP BY ALL""",
    closing=CLOSING,
)
def stream_daily_speed(spark, d):
    """Batch mart over a silver table that a stream filled."""
    silver = live.speed_stream(inputs.closings_of(event_stream(spark, d)))
    return speed.daily_speed_trend(drained(lambda out, state: live.to_files(silver, out, state), spark))


CLOSED = "w + INTERVAL 5 SECOND <= (SELECT max(devicetime) FROM pos) - INTERVAL 30 SECOND"


@geo_case("stream_spacing_last", f"SELECT {', '.join(PAIR_COLUMNS)} FROM pairs WHERE {CLOSED}", **LAST)
def stream_spacing_last(spark, d):
    positions = inputs.positions_of(event_stream(spark, d))
    lanes = inputs.lanes(spark, d)
    pairs = live.spacing_stream(positions, inputs.devices(spark, d), lanes, one_per_truck=True).select(*PAIR_COLUMNS)
    return drained(lambda out, state: live.to_files(pairs, out, state), spark)


@geo_case(
    "stream_spacing_fenced",
    f"SELECT {', '.join(PAIR_COLUMNS)}, geofence_name FROM fenced WHERE {CLOSED}",
)
def stream_spacing_fenced(spark, d):
    """The stream with a row for each geofence that the follower is in."""
    pairs = live.spacing_stream(
        inputs.positions_of(event_stream(spark, d)), inputs.devices(spark, d), inputs.lanes(spark, d), inputs.geofences(spark, d)
    ).select(*PAIR_COLUMNS, "geofence_name")
    return drained(lambda out, state: live.to_files(pairs, out, state), spark)


@geo_case(
    "stream_spacing",
    f"SELECT {', '.join(PAIR_COLUMNS)} FROM pairs WHERE w + INTERVAL 5 SECOND <= (SELECT max(devicetime) FROM pos) - INTERVAL 30 SECOND",
)
def stream_spacing(spark, d):
    """Windows that have closed by the end of the stream, as append output emits them."""
    live_positions = inputs.positions_of(event_stream(spark, d))
    pairs = live.spacing_stream(live_positions, inputs.devices(spark, d), inputs.lanes(spark, d)).select(*PAIR_COLUMNS)
    return drained(lambda out, state: live.to_files(pairs, out, state), spark)


@case(
    "stream_spacing_windows",
    f"""SELECT window_start, window_start + INTERVAL 5 MINUTE AS window_end, Interval, Hari, week_of_year, {means("jarak_waktu", "jarak")}
        FROM labelled WHERE devicetime IS NOT NULL
          AND window_start + INTERVAL 5 MINUTE <= (SELECT max(devicetime) FROM spaced) - INTERVAL 30 SECOND GROUP BY ALL""",
    **ROLLUP,
)
def stream_spacing_windows(spark, d):
    rows = live.rollup_stream(inputs.spacing_rows_of(event_stream(spark, d)), "gps")
    return drained(lambda out, state: live.to_files(rows, out, state), spark)


@case(
    "stream_spacing_overall",
    f"SELECT KM, Hari, week_of_year, {means('jarak_waktu')} FROM labelled WHERE KM <> '' AND devicetime IS NOT NULL GROUP BY ALL",
    **ROLLUP,
)
def stream_spacing_overall(spark, d):
    """Averages without a window, in complete mode; each batch rewrites the small result."""
    rows = live.overall_stream(inputs.spacing_rows_of(event_stream(spark, d)), "km")
    folder = shared_folder(spark)
    query = (
        rows.writeStream.outputMode("complete")
        .option("checkpointLocation", f"{folder}/state")
        .trigger(availableNow=True)
        .foreachBatch(lambda batch, _: batch.write.mode("overwrite").parquet(f"{folder}/out"))
        .queryName(f"overall_{uuid.uuid4().hex}")
        .start()
    )
    query.awaitTermination()
    return spark.read.parquet(f"{folder}/out")


# --- what streams tell about themselves -----------------------------------------------


def logged(spark, start):
    """Run a stream with a log of its batches; the log."""
    folder = shared_folder(spark)
    log = watch.StreamLog(spark, f"{folder}/log")
    spark.streams.addListener(log)
    try:
        log.run(start(folder))
    finally:
        spark.streams.removeListener(log)
    return log


@case(
    "stream_expectations",
    f"""SELECT 'closing.valid_timestamps' AS expectation, count(*) AS rows, count(*) FILTER (WHERE event_id % 5 = 0 OR event_id % 7 = 0) AS missed FROM closing
        UNION ALL SELECT 'closing.known_speed', count(*), count(*) FILTER (WHERE average_speed IS NULL) FROM closing""",
    closing=CLOSING,
)
def stream_expectations(spark, d):
    """Rows of the cleaned stream that miss a rule, counted as they pass and logged per batch."""
    raw = inputs.closings_of(event_stream(spark, d))
    raw = raw.withColumns(
        {
            "timestamp_out_local": F.when(F.col("id") % 5 != 0, F.col("timestamp_in_local")),
            "timestamp_in_local": F.when(F.col("id") % 7 != 0, F.col("timestamp_in_local")),
        }
    )
    rules = speed.WATCH_RULES | {"known_speed": "average_speed IS NOT NULL"}
    kept = watch.watched(quality.expect_or_drop(raw, **speed.DROP_RULES), "closing", rules)
    log = logged(spark, lambda folder: live.to_files(kept.select("id"), f"{folder}/out", f"{folder}/state"))
    return log.expectations().groupBy("expectation").agg(F.sum("rows").alias("rows"), F.sum("missed").alias("missed"))


@geo_case(
    "stream_spacing_expectations",
    f"""SELECT 'spacing.paired_trucks_present' AS expectation, count(*) AS rows, count(*) FILTER (WHERE truk IS NULL OR truk_depan IS NULL) AS missed FROM pairs WHERE {CLOSED}
        UNION ALL SELECT 'spacing.non_negative_jarak', count(*), count(*) FILTER (WHERE NOT (jarak IS NULL OR jarak >= 0)) FROM pairs WHERE {CLOSED}""",
)
def stream_spacing_expectations(spark, d):
    pairs = live.spacing_stream(inputs.positions_of(event_stream(spark, d)), inputs.devices(spark, d), inputs.lanes(spark, d))
    seen = watch.watched(pairs, "spacing", tracking.EXPECTATIONS)
    log = logged(spark, lambda folder: live.to_files(seen, f"{folder}/out", f"{folder}/state"))
    return log.expectations().groupBy("expectation").agg(F.sum("rows").alias("rows"), F.sum("missed").alias("missed"))


@case(
    "stream_late_rows",
    """WITH p AS (SELECT *, event_id % 4 = 0 AS second FROM events), w AS (SELECT max(ts) - INTERVAL 3 DAY AS mark FROM p WHERE NOT second)
       SELECT count(*) AS input_rows, count(*) FILTER (WHERE second AND ts <= mark) AS dropped, count(*) FILTER (WHERE NOT second OR ts > mark) AS kept FROM p, w""",
)
def stream_late_rows(spark, d):
    """Every fourth event comes in a second batch; what the watermark has passed by then is dropped and counted."""
    events = inputs.table(spark, d, "events").select("event_id", F.col("ts").cast("timestamp").alias("ts"))
    source = f"{shared_folder(spark)}/events"
    state = {}
    late = F.col("event_id") % 4 == 0

    def start(folder):
        state["out"] = f"{folder}/out"
        stream = live.event_time(live.file_stream(spark, source, events.schema), "ts", "3 days")
        return live.to_files(stream.dropDuplicatesWithinWatermark(["event_id"]), f"{folder}/out", f"{folder}/state")

    folder = shared_folder(spark)
    log = watch.StreamLog(spark, f"{folder}/log")
    spark.streams.addListener(log)
    try:
        for part in (~late, late):
            events.where(part).write.mode("append").parquet(source)
            log.run(start(folder))
            log.forget()
    finally:
        spark.streams.removeListener(log)
    kept = spark.read.parquet(state["out"]).agg(F.count(F.lit(1))).scalar()
    return log.late().agg(F.sum("input_rows").alias("input_rows"), F.sum("dropped").alias("dropped"), kept.alias("kept"))


@case(
    "stream_tables",
    f"""SELECT event_id AS id, {BAND} AS speed_category, CAST(timestamp_in AS DATE) AS date, company_code_standard FROM closing""",
    closing=CLOSING,
)
def stream_tables(spark, d):
    """Files to a catalog table, and from that table on to another, each with its own checkpoint."""
    folder, mark = shared_folder(spark), uuid.uuid4().hex[:10]
    bronze, silver = f"closing_bronze_{mark}", f"closing_silver_{mark}"
    live.to_table(inputs.closings_of(event_stream(spark, d)), bronze, f"{folder}/bronze").awaitTermination()
    rows = live.speed_stream(live.table_stream(spark, bronze)).select("id", "speed_category", "date", "company_code_standard")
    live.to_table(rows, silver, f"{folder}/silver").awaitTermination()
    out = cut_lineage(spark.table(silver))
    for name in (bronze, silver):
        tables.drop_table(spark, name)
    return out
