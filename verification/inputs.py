"""Raw haulage tables derived by Spark from the given tables, row for row.

Purchases become weighings, views loadings, clicks plant visits, errors stockpile visits
and reclaims, signups stockpile entries.  Messy spellings and missing-value markers are put
in on purpose; every row of the given tables is used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tonflow.settings import CONTRACTORS
from tonflow.sources.session import session_defaults

CODES = list(CONTRACTORS)
ROM_NAMES = ["ROM A1 EXTEND", "rom a2p", " ROM A3 GH ", "ROM B1", "ROM B2", "PIT C APL", "YARD 9", "ROM-A3"]
PORT_NAMES = ["SITE CP 7", "CP-2B", "NORTH STOCKPILE", "SITE PORT", "\\N"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    session_defaults(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def pick(values: list[str], index: Column) -> Column:
    return F.get(F.array(*[F.lit(v) for v in values]), index.cast("int"))


def every(n: int, value: Column | str, otherwise: Column | str | None = None, at: int = 0) -> Column:
    """``value`` on each n-th event, else ``otherwise``."""
    as_col = lambda v: v if isinstance(v, Column) else F.lit(v)
    return F.when(F.col("event_id") % n == at, as_col(value)).otherwise(as_col(otherwise))


def stamp(c: Column, iso: bool = False) -> Column:
    return F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss'Z'" if iso else "yyyy-MM-dd HH:mm:ss")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events_of(table(spark, sf_dir, "events"))


def events_of(e: DataFrame) -> DataFrame:
    """Events with second precision and a truck number; also for a stream of events."""
    code = pick(CODES, F.col("user_id") % len(CODES))
    return e.withColumns(
        {
            "ts": F.date_trunc("second", F.col("ts").cast("timestamp")),
            "unit": F.concat_ws(" ", code, F.lpad(F.col("user_id").cast("string"), 4, "0")),
            "kg": F.round(F.col("value") * 100).cast("long") + 20000,
        }
    )


def minutes(n: Column | int) -> Column:
    return F.make_dt_interval(mins=n if isinstance(n, Column) else F.lit(n))


def material() -> Column:
    n = F.col("event_id")
    full = F.concat(
        F.lit("RA"), (n % 3 + 1).cast("string"), F.lit(".SEAM"), (n % 4).cast("string"), F.lit(".BR.ST")
    )
    return every(10, "RA1.SEAM2", full)


def weighings(spark: SparkSession, sf_dir: str) -> DataFrame:
    n, ts = F.col("event_id"), F.col("ts")
    local = ts + F.make_dt_interval(hours=F.lit(8))
    kg = F.col("kg")
    return events(spark, sf_dir).where("event_type = 'purchase'").select(
        (F.lit(100_000_000_000_000_000) + n).cast("string").alias("id"),
        F.concat(F.lit(" "), F.lower("unit"), F.lit(" ")).alias("truck"),
        F.concat(F.lit("D"), (F.col("user_id") % 50).cast("string")).alias("driver"),
        pick(["kusan ", "girimulya", "\\N"], n % 3).alias("client"),
        material().alias("material"),
        F.concat(F.lit("R"), (F.col("user_id") % 5).cast("string")).alias("hauling"),
        pick(["RTP", "PTP"], n % 2).alias("coal"),
        every(6, F.lower(F.substring("unit", 1, 3)), "null", at=1).alias("code"),
        every(6, "gec", "\\N").alias("hauling_contractor"),
        every(4, "\\N", stamp(ts)).alias("timestamp_gross_utc"),
        stamp(local).alias("timestamp_gross_local"),
        stamp(local + minutes(1)).alias("timestamp_in_local"),
        every(7, F.lit(None).cast("string"), stamp(local + minutes(9))).alias("timestamp_out_local"),
        (kg + 12000).cast("string").alias("gross"),
        F.lit("12000").alias("tare"),
        every(50, "\\N", kg.cast("string")).alias("netto"),
        (kg - (n % 7) * 10).cast("string").alias("netto_ucan"),
        pick(ROM_NAMES, n % 8).alias("last_rom_name"),
        pick(PORT_NAMES, (n * 7 + F.col("user_id")) % 5).alias("last_port_name"),
        every(9, "null", stamp(local - minutes((20 + n % 60).cast("int")))).alias("last_rom_date_time"),
        stamp(local + minutes((15 + n % 90).cast("int"))).alias("last_port_date_time"),
        F.round(F.col("value") % 16, 2).cast("string").alias("average_speed"),
        pick(["ACTUAL", "ACTUAL", "ACTUAL", "MANUAL", "ACTUAL"], n % 5).alias("status_trx_wim"),
        every(11, "Adjust", "").alias("adjustment_result"),
        every(13, "Overload", "").alias("anomaly_message_in"),
        stamp(ts).alias("created_date"),
    )


def visits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Visits; every twentieth comes twice, the second time updated."""
    n, ts, kind = F.col("event_id"), F.col("ts"), F.col("event_type")
    again = F.explode(F.when(n % 20 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    rows = events(spark, sf_dir).where(kind.isin("view", "click", "error"))
    rows = rows.select("*", again.alias("again"))
    plant = F.concat(F.lit("CP "), (n % 9 + 1).cast("string"))
    place = (
        F.when(kind == "view", pick(ROM_NAMES, n % 8))
        .when(kind == "click", plant)
        .otherwise(every(10, "\\N", "North Stockpile"))
    )
    return rows.select(
        n.cast("string").alias("id"),
        F.col("unit").alias("no_lambung"),
        every(3, " PT Angkut ", "null").alias("kontraktor"),
        place.alias("master_location"),
        pick(["GATE3 IN", "gate3", "YARD IN", ""], n % 4).alias("location"),
        pick(["GATE4 OUT", "gate5 out", "null"], n % 3).alias("location_out"),
        material().alias("material"),
        F.concat(F.lit("SK"), (n % 100).cast("string")).alias("sk"),
        pick(["EXCA", "TLS"], n % 2).alias("alat_muat"),
        pick(["RFID", "GEOFENCE"], n % 2).alias("data_source"),
        every(31, "true", "false").alias("is_anomaly"),
        every(41, "true", "false").alias("is_deleted"),
        every(12, "null", (F.col("kg") + F.col("again") * 10 - (n % 5) * 20).cast("string")).alias("tonase"),
        stamp(ts, iso=True).alias("room_in"),
        every(6, "null", stamp(ts + minutes((5 + n % 40).cast("int")), iso=True)).alias("room_out"),
        stamp(ts + minutes((F.col("again") * 60).cast("int")), iso=True).alias("updated_at"),
    )


def movements(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.col("event_id")
    kind = F.when(F.col("event_type") == "signup", "in ").otherwise("OUT")
    return events(spark, sf_dir).where("event_type IN ('signup', 'error')").select(
        n.cast("string").alias("id"),
        stamp(F.col("ts"), iso=True).alias("transaction_date"),
        every(30, "ADJ", kind).alias("movement"),
        every(25, "0", F.col("kg").cast("string")).alias("quantity"),
        F.lit(" north stockpile ").alias("location"),
        pick(["RFID", "GEOFENCE"], n % 2).alias("source_system"),
        pick(["FINAL", "FINAL", "DRAFT"], n % 3).alias("status"),
        every(15, "manual entry", F.concat(F.lit("Auto stock mutation for "), F.col("unit"))).alias("remarks"),
    )


def queue_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Plant queue assignments in text, from order lines and their orders."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate", "o_orderstatus", "o_orderpriority")
    li = table(spark, sf_dir, "lineitem")
    used = ["l_orderkey", "l_linenumber", "l_suppkey", "l_partkey", "l_quantity", "l_returnflag", "l_linestatus"]
    # The join deals the rows while they are narrow (the texts are several times as wide), once at every size:
    # it neither leaves them in the parts of a small file nor sorts them.
    rows = li.select(*used).join(o.hint("shuffle_hash"), F.col("l_orderkey") == F.col("o_orderkey"))
    n = F.col("l_orderkey") * 10 + F.col("l_linenumber")
    start = F.col("o_orderdate").cast("timestamp") + minutes((n % 1440).cast("int"))
    gone = start + minutes((n % 97 - 5).cast("int"))
    slash = F.date_format(start, "M/d/yyyy H:mm")
    dashed = F.date_format(start, "yyyy-MM-dd HH:mm:ss")
    nth = lambda k, v, other: F.when(n % k == 0, v).otherwise(other)
    return rows.select(
        nth(83, F.lit("\\N"), n.cast("string")).alias("assignment_id"),
        nth(71, F.lit("x"), F.col("l_suppkey").cast("string")).alias("truck_id"),
        F.col("l_linenumber").cast("string").alias("lane_id"),
        F.concat(F.lit("LANE "), F.col("l_linenumber").cast("string")).alias("lane_sb"),
        F.concat(F.lit("1,"), F.lpad(F.col("l_quantity").cast("int").cast("string"), 3, "0")).alias("tonnage"),
        F.concat(F.lit("CP"), (F.col("l_partkey") % 9 + 1).cast("string")).alias("queue_name"),
        F.col("l_returnflag").alias("port"),
        F.col("l_linestatus").alias("truck_type"),
        F.when(F.col("o_orderstatus") == "F", "COMPLETED").when(F.col("o_orderstatus") == "O", "OPEN").alias("status"),
        F.concat(F.lit("T"), F.col("l_suppkey").cast("string")).alias("nomor_lambung"),
        F.col("o_orderpriority").alias("assigned_by"),
        nth(3, F.lit("YES"), F.lit(" f ")).alias("is_anomaly"),
        nth(29, F.lit("1"), F.lit("maybe")).alias("is_anomaly_queue_lane"),
        nth(2, slash, dashed).alias("created_at"),
        nth(19, F.lit(""), nth(2, dashed, slash)).alias("entrance_time"),
        nth(13, F.lit("\\N"), F.date_format(gone, "yyyy-MM-dd HH:mm:ss")).alias("exit_cp_time"),
        nth(5, F.lit("garbage"), dashed).alias("rfid_cp_time"),
        F.concat(F.date_format(gone + F.make_dt_interval(hours=F.lit(8)), "yyyy-MM-dd HH:mm:ss"), F.lit(".376713+08")).alias("rfid_cp_out_time"),
        dashed.alias("rfid_queue_time"),
        F.date_format(start + minutes((n % 33).cast("int")), "M/d/yy H:mm:ss").alias("exit_antrian_cp_time"),
    )


PLACES = ["CP1", "CP6", "CP9", "CP2New", "CV14", "CV22", "CV15A", "CV23B", "YARD"]


def totaliser_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counter readings; every tenth came twice, the copy received later and corrected."""
    n = F.col("event_id")
    again = F.explode(F.when(n % 10 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    return events(spark, sf_dir).select("*", again.alias("again")).select(
        pick(PLACES, F.col("user_id") % len(PLACES)).alias("location"),
        F.date_trunc("minute", F.col("ts")).alias("timestamp_data"),
        (F.col("ts") + minutes(F.col("again").cast("int"))).alias("created_at"),
        every(17, F.lit(None).cast("long"), F.col("kg") + F.col("again") * 10).alias("totalizer_today"),
        (F.col("kg") * 3).alias("totalizer_this_month"),
        (F.col("kg") * 2).alias("totalizer_last_month"),
        (F.col("kg") * 5).alias("totalizer_total_month"),
    )


def equipment_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.col("event_id")
    names = ["CP4_Chain_Feeder", "FEEDER_BREAKER_STATUS", "Main Crusher", "Belt conveyor 3", "Pump"]
    return events(spark, sf_dir).select(
        (F.col("user_id") % 12 + 1).cast("int").alias("cp_id"),
        pick(names, n % 5).alias("name"),
        pick(["Running", "Running", "Stopped"], n % 3).alias("status"),
        F.col("ts").alias("created_at"),
        n.alias("log_id"),
    )


# --- positions ----------------------------------------------------------------------


def lanes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parallel roads, one per nation; two nations share a road so that names compete."""
    key = F.col("n_nationkey")
    lon = (115.0 + F.floor(key / 2) * 0.0002).cast("string")
    wkt = F.concat(F.lit("LINESTRING ("), lon, F.lit(" -3.5, "), lon, F.lit(" -3.45, "), lon, F.lit(" -3.4)"))
    return table(spark, sf_dir, "nation").select(
        key.cast("string").alias("id"),
        F.col("n_name").alias("nama_jalur"),
        pick(["MUATAN", "KOSONGAN"], F.floor(key / 2) % 2).alias("arah"),
        wkt.alias("koordinat_jalur"),
    )


def positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return positions_of(table(spark, sf_dir, "events"))


def positions_of(e: DataFrame) -> DataFrame:
    """Positions on, beside and off the roads.

    Time is folded into one hour so that trucks meet in the same five seconds.
    """
    n = F.col("event_id")
    second = (F.unix_seconds("ts") % 3600).cast("int")
    return events_of(e).select(
        n.alias("id"),
        F.col("user_id").alias("deviceid"),
        (F.lit("2024-01-01 05:30:00").cast("timestamp") + F.make_dt_interval(secs=second)).alias("devicetime"),
        F.col("ts").alias("servertime"),
        (-3.5 + (n % 1000) * 0.0001).alias("latitude"),
        # Every third position lies about 11 m east of its road.
        (115.0 + (F.col("user_id") % 13) * 0.0002 + F.when(n % 3 == 0, 0.0001).otherwise(0.0)).alias("longitude"),
        (F.col("kg") % 400 / 10.0).alias("speed"),
        ((F.col("user_id") * 45 + n % 7) % 361).cast("double").alias("course"),
        pick(["[0,1]", "[2]", "[]", "[a, 3]"], n % 4).alias("geofenceids"),
        F.when(n % 37 == 0, 0).otherwise(1).alias("valid"),
        F.concat(F.lit("road "), (n % 5).cast("string")).alias("address"),
    )


def devices(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("c_custkey")
    return table(spark, sf_dir, "customer").where(key % 11 != 0).select(
        key.alias("id"),
        F.concat(pick(CODES, key % len(CODES)), F.lit(" "), key.cast("string")).alias("name"),
        pick(["online", "offline", "unknown"], key % 3).alias("status"),
        F.col("c_mktsegment").alias("category"),
    )


def geofences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Squares whose corners are spread over two columns; one per region is broken."""
    key = F.col("r_regionkey")
    lat, lon = (-3.5 + key * 0.01), (115.0 + key * 0.01)
    corner = lambda a, b: F.concat_ws(" ", F.round(lat + a, 3).cast("string"), F.round(lon + b, 3).cast("string"))
    area = F.concat(F.lit("POLYGON (("), corner(0.0, 0.0), F.lit(", "), corner(0.0, 0.005), F.lit(", "))
    rest = F.concat(corner(0.005, 0.005), F.when(key == 4, F.lit(" x y")).otherwise(F.lit("")))
    return table(spark, sf_dir, "region").select(
        key.cast("long").alias("id"),
        F.concat(F.lit("KM "), (key * 1.5).cast("string"), F.lit(" "), F.col("r_name")).alias("name"),
        F.lit(None).cast("string").alias("description"),
        area.alias("area"),
        rest.alias("attributes"),
    )


def closings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return closings_of(table(spark, sf_dir, "events"))


def closings_of(e: DataFrame) -> DataFrame:
    """Closing transactions, one per event."""
    n, local = F.col("event_id"), F.col("ts") + F.make_dt_interval(hours=F.lit(8))
    speed = F.round(F.col("value") % 16, 2)
    return events_of(e).select(
        n.alias("id"),
        F.col("unit").alias("truck"),
        every(40, F.lit(None).cast("string"), F.lower(F.substring("unit", 1, 3))).alias("code"),
        pick(["ACTUAL", "ACTUAL", "MANUAL"], n % 3).alias("status_trx_wim"),
        F.when(n % 15 == 0, F.lit(None).cast("double")).when(n % 16 == 0, -1.0).otherwise(speed).alias("average_speed"),
        every(60, "bad", stamp(local)).alias("timestamp_in_local"),
        stamp(local + minutes(9)).alias("timestamp_out_local"),
        stamp(local).alias("timestamp_gross_local"),
        F.col("ts").alias("created_date"),
    )


def order_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A source to merge into orders: newer, equal and older versions, and new keys."""
    o = orders(spark, sf_dir)
    key = F.col("o_orderkey")
    changed = o.where(key % 3 == 0).select(
        key,
        "o_custkey",
        F.lit("X").alias("o_orderstatus"),
        (F.col("o_totalprice") + 1).alias("o_totalprice"),
        F.when(key % 2 == 0, F.date_add(F.col("o_orderdate"), 1)).otherwise(F.col("o_orderdate")).alias("o_orderdate"),
    )
    fresh = o.where(key % 50 == 1).select(
        (-key).alias("o_orderkey"), "o_custkey", F.lit("N").alias("o_orderstatus"), "o_totalprice", "o_orderdate"
    )
    return changed.unionByName(fresh)


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", F.col("o_orderdate").cast("date").alias("o_orderdate")
    )


def spacing_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spacing_rows_of(table(spark, sf_dir, "events"))


def spacing_rows_of(e: DataFrame) -> DataFrame:
    """Ready-made spacing rows, one per event."""
    n = F.col("event_id")
    km = F.concat(F.lit("KM "), (n % 20 / 2.0).cast("string"), F.lit(" north"))
    return events_of(e).select(
        every(90, F.lit(None).cast("timestamp"), F.col("ts")).alias("devicetime"),
        every(4, "Gate", km).alias("geofence_name"),
        F.substring("unit", 1, 3).alias("grup_truk"),
        F.round("value", 0).alias("jarak"),
        every(5, F.lit(None).cast("double"), F.round(F.col("value") * 2, 0)).alias("jarak_waktu"),
        n.cast("string").alias("truk_id"),
        (n + 1).cast("string").alias("truk_depan_id"),
    )
