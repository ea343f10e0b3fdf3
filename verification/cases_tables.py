"""Tables: reading by condition, changing, loading, profiling, parsing."""

from __future__ import annotations

import uuid
from datetime import timedelta

from pyspark.sql import functions as F

from tonflow.functions import codes, numbers, text, times
from tonflow.operators import ordered, quality, tables, windows
from tonflow.sources.files import file_inventory, read_csv_text
from tonflow.sources.increments import add_batch_columns, increment, with_columns_of
from tonflow.sources.session import cut_lineage, shared_folder
from tonflow.sources.tables import first_usable, optional_table, resolve
from tonflow.streaming import flows
from verification import inputs
from verification.ctes import pct, rd
from verification.registry import case

ORDERS = "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, CAST(o_orderdate AS DATE) AS o_orderdate FROM orders"
CHANGES = f"""
    SELECT o_orderkey, o_custkey, 'X' AS o_orderstatus, o_totalprice + 1 AS o_totalprice,
           CASE WHEN o_orderkey % 2 = 0 THEN o_orderdate + 1 ELSE o_orderdate END AS o_orderdate FROM ({ORDERS}) WHERE o_orderkey % 3 = 0
    UNION ALL SELECT -o_orderkey, o_custkey, 'N', o_totalprice, o_orderdate FROM ({ORDERS}) WHERE o_orderkey % 50 = 1"""


@case(
    "merge_upsert",
    f"""SELECT coalesce(t.o_orderkey, s.o_orderkey) AS o_orderkey, coalesce(s.o_custkey, t.o_custkey) AS o_custkey,
               coalesce(s.o_orderstatus, t.o_orderstatus) AS o_orderstatus, coalesce(s.o_totalprice, t.o_totalprice) AS o_totalprice,
               coalesce(s.o_orderdate, t.o_orderdate) AS o_orderdate
        FROM ({ORDERS}) t FULL JOIN ({CHANGES}) s ON t.o_orderkey = s.o_orderkey""",
)
def merge_upsert(spark, d):
    return tables.merge_upsert(inputs.orders(spark, d), inputs.order_changes(spark, d), ["o_orderkey"])


_NEWER = "t.o_orderkey IS NULL OR s.o_orderdate > t.o_orderdate"


@case(
    "merge_newer",
    f"""SELECT coalesce(t.o_orderkey, s.o_orderkey) AS o_orderkey,
               CASE WHEN {_NEWER} THEN s.o_custkey ELSE t.o_custkey END AS o_custkey,
               CASE WHEN {_NEWER} THEN s.o_orderstatus ELSE t.o_orderstatus END AS o_orderstatus,
               CASE WHEN {_NEWER} THEN s.o_totalprice ELSE t.o_totalprice END AS o_totalprice,
               CASE WHEN {_NEWER} THEN s.o_orderdate ELSE t.o_orderdate END AS o_orderdate
        FROM ({ORDERS}) t FULL JOIN ({CHANGES}) s ON t.o_orderkey = s.o_orderkey""",
)
def merge_newer(spark, d):
    return tables.merge_upsert(
        inputs.orders(spark, d), inputs.order_changes(spark, d), ["o_orderkey"], newer="o_orderdate", null_safe=False
    )


@case(
    "update_where",
    f"""SELECT o_orderkey, o_custkey, CASE WHEN o_orderstatus = 'P' THEN 'Q' ELSE o_orderstatus END AS o_orderstatus,
               CASE WHEN o_orderstatus = 'P' THEN 0.0 ELSE o_totalprice END AS o_totalprice, o_orderdate FROM ({ORDERS})""",
)
def update_where(spark, d):
    return tables.update_where(inputs.orders(spark, d), F.col("o_orderstatus") == "P", {"o_orderstatus": "Q", "o_totalprice": 0})


@case("delete_where", f"SELECT * FROM ({ORDERS}) WHERE NOT (o_totalprice > 200000)")
def delete_where(spark, d):
    return tables.delete_where(inputs.orders(spark, d), F.col("o_totalprice") > 200000)


@case(
    "insert_rows",
    f"""SELECT * FROM ({ORDERS}) UNION ALL
        SELECT c_custkey + 1000000000, c_custkey, NULL, NULL, NULL FROM customer""",
)
def insert_rows(spark, d):
    rows = inputs.table(spark, d, "customer").select(
        (F.col("c_custkey") + 1_000_000_000).alias("o_orderkey"), F.col("c_custkey").alias("o_custkey")
    )
    return tables.insert_rows(inputs.orders(spark, d), rows)


@case("page", f"SELECT * FROM ({ORDERS}) WHERE o_orderstatus = 'F' ORDER BY o_orderkey LIMIT 10 OFFSET 20")
def page(spark, d):
    return tables.page(inputs.orders(spark, d), ["o_orderkey"], 10, 20, {"o_orderstatus": "F"})


@case("page_total", "SELECT count(*) AS total FROM orders WHERE o_orderstatus = 'F'")
def page_total(spark, d):
    return tables.page_total(inputs.orders(spark, d), {"o_orderstatus": "F"})


@case("find_by_fields", f"SELECT * FROM ({ORDERS}) WHERE o_custkey = 7 AND o_orderstatus = 'O'")
def find_by_fields(spark, d):
    return tables.find(inputs.orders(spark, d), o_custkey=7, o_orderstatus="O")


@case(
    "parameterised_sql",
    "SELECT o_orderstatus, count(*) AS n FROM orders WHERE o_orderdate BETWEEN DATE '1997-01-01' AND DATE '1997-12-31' GROUP BY ALL",
)
def parameterised_sql(spark, d):
    tables.temp_view(inputs.orders(spark, d), "orders_by_day")
    return tables.query(
        spark,
        """SELECT o_orderstatus, count(*) AS n FROM orders_by_day
           WHERE o_orderdate BETWEEN CAST(:first AS DATE) AND CAST(:last AS DATE) GROUP BY o_orderstatus""",
        first="1997-01-01",
        last="1997-12-31",
    )


@case("duplicates", "SELECT o_custkey, count(*) AS duplicate_count FROM orders GROUP BY ALL HAVING count(*) > 1")
def duplicates(spark, d):
    return tables.duplicates(inputs.orders(spark, d), ["o_custkey"])


@case(
    "duplicates_top",
    "SELECT o_custkey, count(*) AS duplicate_count FROM orders GROUP BY ALL HAVING count(*) > 1 ORDER BY 2 DESC, 1 LIMIT 10",
)
def duplicates_top(spark, d):
    return tables.duplicates(inputs.orders(spark, d), ["o_custkey"], 10)


@case("distinct_rows", "SELECT DISTINCT l_suppkey, l_returnflag, l_linestatus FROM lineitem")
def distinct_rows(spark, d):
    return inputs.table(spark, d, "lineitem").select("l_suppkey", "l_returnflag", "l_linestatus").distinct()


@case(
    "latest_per_key",
    """SELECT c_custkey, c_mktsegment, e.event_id, e.event_type, e.value FROM customer LEFT JOIN (
           SELECT * FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1) e ON c_custkey = user_id""",
)
def latest_per_key(spark, d):
    last = windows.first_per_key(inputs.table(spark, d, "events"), ["user_id"], [F.desc("ts"), F.desc("event_id")])
    known = inputs.table(spark, d, "customer").select("c_custkey", "c_mktsegment")
    return known.join(last, F.col("c_custkey") == F.col("user_id"), "left").select(
        "c_custkey", "c_mktsegment", "event_id", "event_type", "value"
    )


@case(
    "top_per_group",
    """SELECT l_suppkey, l_orderkey, l_linenumber, l_extendedprice, CAST(rank AS INTEGER) AS rank FROM (
           SELECT *, row_number() OVER (PARTITION BY l_suppkey ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber, l_partkey, l_quantity) AS rank FROM lineitem)
       WHERE rank <= 3""",
)
def top_per_group(spark, d):
    li = inputs.table(spark, d, "lineitem")
    order = [F.desc("l_extendedprice"), "l_orderkey", "l_linenumber", "l_partkey", "l_quantity"]
    return windows.top_per_key(li, ["l_suppkey"], order, 3, "rank").select(
        "l_suppkey", "l_orderkey", "l_linenumber", "l_extendedprice", "rank"
    )


@case(
    "running_total",
    f"""SELECT event_id, {rd("10 + sum(CASE event_type WHEN 'purchase' THEN value WHEN 'error' THEN -value ELSE 0 END) OVER (ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING)", 4)} AS balance FROM events""",
)
def running_total(spark, d):
    e = inputs.table(spark, d, "events")
    signed = codes.cases([(F.col("event_type") == "purchase", F.col("value")), (F.col("event_type") == "error", -F.col("value"))], 0.0)
    e = e.withColumns({"ts": F.col("ts").cast("timestamp"), "signed": signed})
    rows = ordered.running_total(e, ["ts", "event_id"], "signed", name="balance", opening=10.0)
    return rows.select("event_id", numbers.steady("balance", 4).alias("balance"))


@case(
    "running_total_by_key",
    f"""SELECT event_id, {rd("sum(value) OVER (PARTITION BY event_type ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING)", 4)} AS total FROM events""",
)
def running_total_by_key(spark, d):
    e = inputs.table(spark, d, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    rows = ordered.running_total(e, ["ts", "event_id"], "value", ["event_type"], "total")
    return rows.select("event_id", numbers.steady("total", 4).alias("total"))


@case(
    "price_quantiles",
    f"""SELECT l_returnflag, l_linestatus, quantile_disc(l_extendedprice, 0.1) AS p10, quantile_disc(l_extendedprice, 0.5) AS p50,
        quantile_disc(l_extendedprice, 0.99) AS p99 FROM lineitem GROUP BY ALL""",
)
def price_quantiles(spark, d):
    """Exact quantiles of raw rows in a few large groups."""
    li = inputs.table(spark, d, "lineitem").select("l_returnflag", "l_linestatus", "l_extendedprice")
    return ordered.quantiles(li, ["l_returnflag", "l_linestatus"], "l_extendedprice", [0.1, 0.5, 0.99], ["p10", "p50", "p99"])


@case(
    "row_numbers_text",
    "SELECT o_orderkey, row_number() OVER (ORDER BY o_orderpriority, o_orderkey) AS position FROM orders",
)
def row_numbers_text(spark, d):
    o = inputs.table(spark, d, "orders").select("o_orderkey", "o_orderpriority")
    return ordered.row_numbers(o, ["o_orderpriority", "o_orderkey"], "position").drop("o_orderpriority")


@case(
    "row_numbers",
    "SELECT o_orderkey, row_number() OVER (ORDER BY o_totalprice, o_orderkey) AS position FROM orders",
)
def row_numbers(spark, d):
    o = inputs.orders(spark, d).select("o_orderkey", "o_totalprice")
    return ordered.row_numbers(o, ["o_totalprice", "o_orderkey"], "position").drop("o_totalprice")


@case(
    "robust_z",
    f"""WITH r AS (SELECT CAST(l_shipdate AS DATE) AS day, s_nationkey, {rd("sum(l_extendedprice * (1 - l_discount))", 2)} AS revenue
                   FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY ALL),
        m AS (SELECT *, quantile_disc(revenue, 0.5) OVER (PARTITION BY s_nationkey) AS median FROM r),
        a AS (SELECT *, quantile_disc(abs(revenue - median), 0.5) OVER (PARTITION BY s_nationkey) AS mad FROM m)
        SELECT day, s_nationkey, revenue, median, {rd("mad", 2)} AS mad,
               CASE WHEN mad > 0 THEN {rd("0.6745 * (revenue - median) / CASE WHEN mad > 0 THEN mad END", 2)} ELSE 0.0 END AS robust_z FROM a""",
)
def robust_z(spark, d):
    s = inputs.table(spark, d, "supplier").select("s_suppkey", "s_nationkey")
    li = inputs.table(spark, d, "lineitem").join(s, F.col("l_suppkey") == F.col("s_suppkey"))
    revenue = numbers.rsum(F.col("l_extendedprice") * (1 - F.col("l_discount")), 2).alias("revenue")
    daily = li.groupBy(F.to_date("l_shipdate").alias("day"), "s_nationkey").agg(revenue)
    return windows.robust_z(daily, "revenue", ["s_nationkey"]).withColumn("mad", numbers.steady("mad", 2))


@case(
    "share_and_deviation",
    f"""WITH r AS (SELECT l_returnflag, l_suppkey, {rd("sum(l_quantity)", 2)} AS qty FROM lineitem GROUP BY ALL),
        w AS (SELECT *, {rd("sum(qty) OVER (PARTITION BY l_returnflag)", 6)} AS total, {rd("avg(qty) OVER (PARTITION BY l_returnflag)", 3)} AS mean FROM r)
        SELECT *, {pct("qty", "total")} AS share, {rd("(qty - mean) / mean * 100.0", 2)} AS deviation FROM w""",
)
def share_and_deviation(spark, d):
    qty = inputs.table(spark, d, "lineitem").groupBy("l_returnflag", "l_suppkey").agg(numbers.rsum("l_quantity", 2).alias("qty"))
    rows = windows.share_of(qty, "qty", ["l_returnflag"], "total", "share")
    return windows.deviation_from_mean(rows, "qty", ["l_returnflag"], "mean", "deviation")


# --- loading ------------------------------------------------------------------------


@case(
    "increment",
    """SELECT event_id, ts FROM events WHERE ts > (SELECT max(ts) FROM events WHERE event_type = 'signup' AND ts < TIMESTAMP '2024-01-15')""",
)
def increment_events(spark, d):
    e = inputs.table(spark, d, "events").select("event_id", "ts", "event_type")
    loaded = e.where("event_type = 'signup' AND ts < TIMESTAMP_NTZ '2024-01-15'")
    return increment(e, loaded, "ts").drop("event_type")


@case(
    "increment_overlap",
    """WITH t AS (SELECT event_id, ts FROM events WHERE event_type = 'signup' AND ts < TIMESTAMP '2024-01-15')
       SELECT event_id, ts FROM events WHERE ts > (SELECT max(ts) FROM t) - INTERVAL 2 HOUR AND event_id NOT IN (SELECT event_id FROM t)""",
)
def increment_overlap(spark, d):
    e = inputs.table(spark, d, "events").select("event_id", "ts", "event_type")
    loaded = e.where("event_type = 'signup' AND ts < TIMESTAMP_NTZ '2024-01-15'")
    return increment(e, loaded, "ts", timedelta(hours=2), ["event_id"]).drop("event_type")


@case(
    "increment_batch",
    """WITH f AS (SELECT event_id, ts FROM events WHERE ts > (SELECT max(ts) FROM events WHERE event_type = 'signup' AND ts < TIMESTAMP '2024-01-15'))
       SELECT * FROM f WHERE ts <= (SELECT max(ts) FROM (SELECT ts FROM f ORDER BY ts LIMIT 100))""",
)
def increment_batch(spark, d):
    e = inputs.table(spark, d, "events").select("event_id", "ts", "event_type")
    loaded = e.where("event_type = 'signup' AND ts < TIMESTAMP_NTZ '2024-01-15'")
    return increment(e, loaded, "ts", keys=["event_id"], limit=100).drop("event_type")


@case("increment_walk", "SELECT event_id, date_trunc('week', ts) AS ts FROM events")
def increment_walk(spark, d):
    """All events in batches over times so coarse that most rows tie, none left behind."""
    e = inputs.table(spark, d, "events").select("event_id", F.date_trunc("week", "ts").alias("ts"))
    loaded = e.limit(0)
    while True:
        batch = cut_lineage(increment(e, loaded, "ts", limit=100))
        if batch.isEmpty():
            return loaded
        loaded = loaded.unionByName(batch)


@case(
    "columns_whitelist",
    "SELECT p_partkey, p_name, CAST(NULL AS VARCHAR) AS p_colour, CAST(NULL AS DOUBLE) AS p_weight FROM part",
)
def columns_whitelist(spark, d):
    wanted = {"p_partkey": "long", "p_name": "string", "p_colour": "string", "p_weight": "double"}
    return with_columns_of(inputs.table(spark, d, "part"), wanted)


@case(
    "batch_history",
    """SELECT event_type AS _batch_id, count(*) AS row_count, min(ts) AS ingested_at, min(ts) AS min_date, max(ts) AS max_date
       FROM events GROUP BY ALL""",
)
def batch_history(spark, d):
    e = inputs.table(spark, d, "events").withColumnRenamed("event_type", "_batch_id")
    return quality.batch_history(e, "_batch_id", "ts", "ts")


@case("batch_columns", "SELECT count(*) AS row_count, 1 AS batches, 1 AS sources FROM orders")
def batch_columns(spark, d):
    """Every row of one load carries the same batch id."""
    rows = add_batch_columns(inputs.orders(spark, d), "orders")
    return rows.agg(
        F.count(F.lit(1)).alias("row_count"),
        F.count_distinct("_batch_id").cast("int").alias("batches"),
        F.count_distinct("_source").cast("int").alias("sources"),
    )


@case("file_inventory")
def files(spark, d):
    return file_inventory(spark, d, "*.parquet").select("file_name", "extension", "kind", "size_bytes", "size_kb")


# --- profiles -----------------------------------------------------------------------


@case(
    "null_profile",
    " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) AS total_rows, count(*) - count({c}) AS null_count, "
        f"{rd(f'(count(*) - count({c})) * 100.0 / count(*)', 2)} AS null_pct FROM j"
        for c in ("doc_id", "lang", "quality", "toxic")
    ),
    j="SELECT d.doc_id, lang, quality, toxic FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id",
)
def null_profile(spark, d):
    docs = inputs.table(spark, d, "documents").select("doc_id", "lang")
    return quality.null_profile(docs.join(inputs.table(spark, d, "labels"), "doc_id", "left"))


@case(
    "table_profile",
    """SELECT 'lineitem' AS table_name, CAST(sum(n) AS BIGINT) AS total_rows, 3 AS total_columns, count(*) FILTER (WHERE n > 1) AS duplicate_groups
       FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_suppkey, l_quantity, l_discount)""",
)
def table_profile(spark, d):
    li = inputs.table(spark, d, "lineitem").select("l_suppkey", "l_quantity", "l_discount")
    return quality.table_profile(li, "lineitem")


@case(
    "inventory",
    """SELECT 'orders' AS table_name, count(*) AS total_rows, 6 AS total_columns FROM orders
       UNION ALL SELECT 'part', count(*), 6 FROM part UNION ALL SELECT 'events', count(*), 6 FROM events""",
)
def inventory(spark, d):
    return quality.inventory({n: inputs.table(spark, d, n) for n in ("orders", "part", "events")})


@case("key_uniqueness", "SELECT count(*) AS total_rows, count(DISTINCT l_orderkey) AS unique_keys FROM lineitem")
def key_uniqueness(spark, d):
    return quality.key_uniqueness(inputs.table(spark, d, "lineitem"), "l_orderkey")


@case(
    "expectation_counts",
    """SELECT count(*) AS total_rows, count(*) FILTER (WHERE NOT value < 100) AS small_value, count(*) FILTER (WHERE event_type = 'error') AS no_error
       FROM events""",
)
def expectation_counts(spark, d):
    e = inputs.table(spark, d, "events")
    return quality.expectation_counts(e, small_value="value < 100", no_error="event_type <> 'error'")


@case("expect_or_drop", "SELECT event_id, value FROM events WHERE value >= 10 AND event_type <> 'error'")
def expect_or_drop(spark, d):
    e = inputs.table(spark, d, "events")
    return quality.expect_or_drop(e, enough="value >= 10", no_error="event_type <> 'error'").select("event_id", "value")


# --- parsing ------------------------------------------------------------------------


@case(
    "parse_timestamps",
    """SELECT o_orderkey, CASE WHEN o_orderkey % 7 IN (5, 6) THEN NULL
              WHEN o_orderkey % 7 IN (0, 2) THEN date_trunc('minute', o_orderdate + to_seconds(o_orderkey % 86400))
              WHEN o_orderkey % 7 = 4 THEN o_orderdate + to_seconds(o_orderkey % 86400) - INTERVAL 8 HOUR + INTERVAL 376713 MICROSECOND
              ELSE o_orderdate + to_seconds(o_orderkey % 86400) END AS parsed FROM orders""",
)
def parse_timestamps(spark, d):
    key = F.col("o_orderkey")
    at = F.col("o_orderdate").cast("timestamp") + F.make_dt_interval(secs=(key % 86400))
    shapes = [
        F.date_format(at, "M/d/yyyy H:mm"),
        F.date_format(at, "yyyy-MM-dd HH:mm:ss"),
        F.date_format(at, "M/d/yyyy H:mm"),
        F.date_format(at, "M/d/yyyy H:mm:ss"),
        F.concat(F.date_format(at, "yyyy-MM-dd HH:mm:ss"), F.lit(".376713+08")),
        F.lit("\\N"),
        F.lit("13/45/garbage"),
    ]
    raw = F.get(F.array(*shapes), (key % 7).cast("int"))
    return inputs.table(spark, d, "orders").select("o_orderkey", times.parse_any(raw).alias("parsed"))


@case(
    "parse_values",
    """SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE o_totalprice END AS amount,
              CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE o_custkey END AS customer,
              CASE o_orderkey % 4 WHEN 0 THEN 'true' WHEN 1 THEN 'false' WHEN 2 THEN NULL ELSE 'true' END AS flag,
              CASE o_orderkey % 4 WHEN 3 THEN 'Y' WHEN 0 THEN 'Yes' WHEN 1 THEN 'F' ELSE '?' END AS word,
              CASE WHEN o_orderkey % 5 = 0 THEN 0.0 ELSE o_totalprice END AS amount_or_zero FROM orders""",
)
def parse_values(spark, d):
    key = F.col("o_orderkey")
    amount = F.when(key % 5 == 0, F.lit("n/a")).otherwise(F.format_number("o_totalprice", 2))
    plain = F.when(key % 5 == 0, F.lit("n/a")).otherwise(F.col("o_totalprice").cast("string"))
    word = inputs.pick([" Yes ", "F", "?", "Y"], key % 4)
    return inputs.table(spark, d, "orders").select(
        "o_orderkey",
        numbers.to_double(amount).alias("amount"),
        numbers.to_long(F.when(key % 3 == 0, F.lit("1.5")).otherwise(F.format_number("o_custkey", 0))).alias("customer"),
        text.to_boolean(word).cast("string").alias("flag"),
        text.present(word).alias("word"),
        numbers.number_or_zero(plain).alias("amount_or_zero"),
    )


@case(
    "json_props",
    """SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
              '{"event_type":"' || event_type || '","user_id":' || user_id || '}' AS packed FROM events""",
)
def json_props(spark, d):
    return inputs.table(spark, d, "events").select(
        "event_id",
        F.from_json("props", "k int")["k"].alias("k"),
        F.to_json(F.struct("event_type", "user_id")).alias("packed"),
    )


@case(
    "norm_codes",
    """SELECT event_id, CASE event_id % 5 WHEN 0 THEN 'CP-7' WHEN 1 THEN 'CP-2B' WHEN 2 THEN 'NORTH-STOCKPILE' WHEN 3 THEN 'PORT-BIB' ELSE 'UNKNOWN' END AS destination,
              CASE event_id % 5 WHEN 0 THEN 'CP7' WHEN 1 THEN 'CP2B' WHEN 2 THEN 'NORTH STOCKPILE' WHEN 3 THEN 'PORT EAST' ELSE 'YARD' END AS short_name,
              '3.' || (event_id % 10) AS km, trim(substr(unit, 1, 4)) AS grouped, (event_id % 9) || ',12' AS ids
       FROM ev""",
)
def norm_codes(spark, d):
    n = F.col("event_id")
    place = inputs.pick(["CP 7", "CP-2B", "North Stockpile", "PORT EAST", "Yard"], n % 5)
    return inputs.events(spark, d).select(
        "event_id",
        codes.destination_code(place).alias("destination"),
        codes.plant_short_name(place).alias("short_name"),
        codes.km_marker(F.concat(F.lit("KM 3."), (n % 10).cast("string"), F.lit(" west"))).alias("km"),
        text.group_prefix(F.concat(F.lit(" "), F.col("unit"))).alias("grouped"),
        F.array_join(text.id_list(F.concat(F.lit("["), (n % 9).cast("string"), F.lit(", 12, x]"))), ",").alias("ids"),
    )


# --- tables in the catalog ------------------------------------------------------------


def own_name(what: str) -> str:
    return f"{what}_{uuid.uuid4().hex[:10]}"


DATED = """SELECT CASE WHEN o_orderkey % 10 = 0 THEN NULL ELSE o_orderkey // 2 END AS id, CAST(o_orderdate AS DATE) AS day FROM orders
    UNION ALL SELECT NULL, CAST(o_orderdate AS DATE) FROM orders WHERE o_orderkey % 10 = 0"""


@case(
    "archive_prune",
    """SELECT CASE WHEN day < (SELECT max(day) FROM dated) - INTERVAL 6 MONTH THEN 'archive' ELSE 'live' END AS place, id, day FROM dated
       UNION ALL SELECT 'archive', o_orderkey // 2, DATE '1980-01-01' FROM orders WHERE o_orderkey % 2 = 0""",
    dated=DATED,
)
def archive_prune(spark, d):
    """Old rows move to an archive that already holds other rows of the same keys; keys repeat and lack."""
    orders = inputs.table(spark, d, "orders")
    key = F.when(F.col("o_orderkey") % 10 != 0, F.floor(F.col("o_orderkey") / 2))
    rows = orders.select(key.alias("id"), F.to_date("o_orderdate").alias("day"))
    rows = rows.unionByName(rows.where("id IS NULL"))
    live, archive = own_name("live"), own_name("archive")
    tables.write_table(rows, live)
    before = orders.where("o_orderkey % 2 = 0").select(F.floor(F.col("o_orderkey") / 2).alias("id"), F.to_date(F.lit("1980-01-01")).alias("day"))
    tables.write_table(before, archive)
    newest = rows.agg(F.max("day")).first()[0]
    tables.archive_and_prune(spark, live, archive, "day", 6, str(newest))
    both = [spark.table(t).select(F.lit(p).alias("place"), "id", "day") for p, t in (("archive", archive), ("live", live))]
    out = cut_lineage(both[0].unionByName(both[1]))
    for name in (live, archive):
        tables.drop_table(spark, name)
    return out


@case(
    "upsert_partitioned",
    """SELECT o_orderkey, o_orderpriority, CASE WHEN o_orderkey % 5 = 0 THEN 'X' ELSE o_orderstatus END AS o_orderstatus, 'o_orderstatus' AS partitions
       FROM orders UNION ALL SELECT -1 - o_orderkey, o_orderpriority, 'X', 'o_orderstatus' FROM orders WHERE o_orderkey % 5 = 0""",
)
def upsert_partitioned(spark, d):
    """Rows change and move to another partition, new ones come, and the table stays partitioned."""
    orders = inputs.table(spark, d, "orders").select("o_orderkey", "o_orderpriority", "o_orderstatus")
    name = own_name("orders")
    tables.write_table(orders, name, partition_by=["o_orderstatus"])
    changed = orders.where("o_orderkey % 5 = 0").withColumn("o_orderstatus", F.lit("X"))
    changed = changed.unionByName(changed.withColumn("o_orderkey", -1 - F.col("o_orderkey")))
    tables.upsert_table(changed, name, ["o_orderkey"])
    parts = ",".join(c.name for c in spark.catalog.listColumns(name) if c.isPartition)
    out = cut_lineage(spark.table(name).withColumn("partitions", F.lit(parts)))
    tables.drop_table(spark, name)
    return out


@case("flows_after_crash", "SELECT event_id, CASE WHEN event_id % 2 = 0 THEN 'history' ELSE 'recent' END AS _source FROM events")
def flows_after_crash(spark, d):
    """A backfill whose run died after its rows were written, run again, and an increment after it."""
    events = inputs.table(spark, d, "events").select("event_id")
    target = own_name("calls")
    old = events.where("event_id % 2 = 0")
    add_batch_columns(old, "history", "half").write.mode("append").partitionBy("_batch_id").saveAsTable(target)
    flows._log(spark, target, "backfill", "half", flows.BEGUN)  # what a run leaves that dies here
    steps = [
        flows.AppendFlow("backfill", lambda _: old, "history", once=True),
        flows.AppendFlow("recurring", lambda _: events.where("event_id % 2 <> 0"), "recent"),
    ]
    flows.run_flows(spark, target, steps)
    out = cut_lineage(flows.committed(spark, target).select("event_id", "_source"))
    for name in (target, flows.log_name(target)):
        tables.drop_table(spark, name)
    return out


@case("csv_round_trip", "SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, o_orderpriority || chr(10) || '\"' || o_orderstatus || '\", ' || o_orderkey AS note FROM orders")
def csv_round_trip(spark, d):
    """Text with line breaks, quotes and commas through a CSV file."""
    note = F.concat_ws("", "o_orderpriority", F.lit('\n"'), "o_orderstatus", F.lit('", '), F.col("o_orderkey").cast("string"))
    path = f"{shared_folder(spark)}/orders"
    inputs.table(spark, d, "orders").select("o_orderkey", note.alias("note")).write.csv(path, header=True, quote='"', escape='"')
    return read_csv_text(spark, path)


@case(
    "resolved_sources",
    """SELECT 'TABLE' AS origin, count(*) AS rows FROM customer UNION ALL SELECT 'FILE', count(*) FROM supplier""",
)
def resolved_sources(spark, d):
    """A source that the catalog knows, and one that only a file has."""
    name, path = own_name("customers"), f"{shared_folder(spark)}/suppliers"
    tables.write_table(inputs.table(spark, d, "customer"), name)
    inputs.table(spark, d, "supplier").write.csv(path, header=True)
    found = [resolve(spark, t, path, read_csv_text) for t in (name, own_name("nothing"))]
    rows = [df.agg(F.lit(origin.split(":")[0]).alias("origin"), F.count(F.lit(1)).alias("rows")) for df, origin in found]
    out = cut_lineage(rows[0].unionByName(rows[1]))
    tables.drop_table(spark, name)
    return out


@case(
    "shipment_first_usable",
    f"""SELECT CAST(l_shipdate AS DATE) AS production_date, {rd("sum(l_quantity)", 3)} AS shipment_ton, false AS is_estimated FROM lineitem GROUP BY ALL""",
)
def shipment_first_usable(spark, d):
    """Of three candidates the first is not there, the second lacks a column, the third serves."""
    lacking, usable = own_name("lacking"), own_name("usable")
    li = inputs.table(spark, d, "lineitem").select(F.col("l_shipdate").alias("day"), F.col("l_quantity").alias("ton"))
    tables.write_table(li.drop("ton"), lacking)
    tables.write_table(li, usable)
    names = [{"table": t, "date_col": "day", "ton_col": "ton"} for t in (own_name("nothing"), lacking, usable)]
    if optional_table(spark, lacking, ["day", "ton"]) is not None:
        raise AssertionError("a table without the column is not usable")
    out = cut_lineage(first_usable(spark, names).drop("shipment_source"))
    for name in (lacking, usable):
        tables.drop_table(spark, name)
    return out


@case(
    "table_life",
    """SELECT 'created' AS step, count(*) AS rows FROM orders WHERE o_orderstatus = 'F' UNION ALL SELECT 'appended', count(*) FROM orders
       UNION ALL SELECT 'written', count(*) FROM orders WHERE o_orderstatus <> 'F' UNION ALL SELECT 'truncated', 0 UNION ALL SELECT 'dropped', 0""",
)
def table_life(spark, d):
    """Created from a query, appended to with the number of rows given back, emptied, dropped."""
    orders, name = inputs.table(spark, d, "orders"), own_name("orders")
    view = tables.temp_view(orders, own_name("orders_view"))
    counts = [("created", tables.write_table(view.where("o_orderstatus = 'F'"), name).count())]
    written = tables.write_counted(orders.where("o_orderstatus <> 'F'"), name)[1]
    counts += [("appended", spark.table(name).count()), ("written", written), ("truncated", tables.truncate_table(spark, name).count())]
    tables.drop_table(spark, name)
    counts.append(("dropped", int(spark.catalog.tableExists(name))))
    return spark.createDataFrame(counts, "step string, rows long")


@case(
    "order_calendar",
    """SELECT CAST(day AS DATE) AS day, count(o_orderkey) AS orders FROM (SELECT unnest(generate_series((SELECT min(CAST(o_orderdate AS DATE)) FROM orders),
       (SELECT max(CAST(o_orderdate AS DATE)) FROM orders), INTERVAL 1 DAY)) AS day) LEFT JOIN orders ON CAST(o_orderdate AS DATE) = day GROUP BY ALL""",
)
def order_calendar(spark, d):
    """Every day between the first and the last order, also those without any."""
    orders = inputs.table(spark, d, "orders").select(F.to_date("o_orderdate").alias("day"), "o_orderkey")
    first, last = orders.agg(F.min("day"), F.max("day")).first()
    days = times.date_range(spark, str(first), str(last))
    return days.join(orders, "day", "left").groupBy("day").agg(F.count("o_orderkey").alias("orders"))
