"""Table changes, loading and quality checks."""

import os
from datetime import date, datetime, timedelta
from urllib.parse import unquote, urlparse

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import Observation
from pyspark.sql import functions as F

from tonflow.operators import quality, tables
from tonflow.sources import (
    JdbcSource,
    RetriesExhausted,
    add_batch_columns,
    first_usable,
    high_watermark,
    increment,
    newer_than,
    optional_table,
    read_csv_text,
    read_with_retry,
    resolve,
    session_defaults,
    with_columns_of,
)
from tonflow.streaming import AppendFlow, flows, run_flows

SCHEMA = "id long, name string, updated timestamp"
OLD, SAME, NEW = datetime(2026, 1, 1), datetime(2026, 2, 1), datetime(2026, 3, 1)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def target(spark):
    return spark.createDataFrame([(1, "a", SAME), (2, "b", SAME), (3, "c", SAME), (None, "n", SAME)], SCHEMA)


def test_upsert_takes_newer_rows_only(spark):
    source = spark.createDataFrame([(1, "A", NEW), (2, "B", SAME), (3, "C", OLD), (4, "D", OLD), (None, "N", NEW)], SCHEMA)
    merged = tables.merge_upsert(target(spark), source, ["id"], newer="updated", null_safe=False)
    assert rows(merged) == sorted(
        [(1, "A", NEW), (2, "b", SAME), (3, "c", SAME), (4, "D", OLD), (None, "n", SAME), (None, "N", NEW)], key=str
    )


def test_upsert_with_null_safe_keys_replaces_all_columns(spark):
    source = spark.createDataFrame([(1, None, OLD), (None, "N", NEW)], SCHEMA)
    merged = tables.merge_upsert(target(spark), source, ["id"])
    assert rows(merged) == sorted([(1, None, OLD), (2, "b", SAME), (3, "c", SAME), (None, "N", NEW)], key=str)


def test_upsert_refuses_repeated_source_keys(spark):
    source = spark.createDataFrame([(1, "x", NEW), (1, "y", NEW)], SCHEMA)
    with pytest.raises(PySparkException, match="more than once"):
        tables.merge_upsert(target(spark), source, ["id"]).collect()


def test_upsert_tasks_stay_small(spark):
    n, changed = 1_200_000, {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "64"}
    before = {k: spark.conf.get(k) for k in changed}
    digest = F.sha2(F.col("id").cast("string"), 256)
    big = spark.range(n).select("id", digest.alias("a"), F.reverse(digest).alias("b"))
    source = spark.range(n - 5, n + 5).select("id", F.lit("x").alias("a"), F.lit("y").alias("b"))
    session_defaults(spark)
    try:
        for key, value in changed.items():
            spark.conf.set(key, value)
        merged = tables.merge_upsert(big, source, ["id"])
        whole = [F.count("*").alias("n"), F.max("a"), F.max("b")]  # columns that nobody reads are not shuffled
        held = [r["n"] for r in merged.groupBy(F.spark_partition_id()).agg(*whole).collect()]
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    assert sum(held) == n + 5
    # A task was given as much as a core's share or 64 MB of compressed bytes before, here 300,000 rows.
    assert max(held) < 250_000


def test_create_read_update_delete(spark):
    t = target(spark)
    t = tables.insert_rows(t, spark.createDataFrame([(9, "z")], "id long, name string"))
    assert rows(tables.find(t, id=9)) == [(9, "z", None)]
    t = tables.update_where(t, F.col("id") == 9, {"name": "zz"})
    assert rows(tables.find(t, id=9, name="zz")) == [(9, "zz", None)]
    assert rows(tables.update_where(t, F.col("id") == 9, {})) == rows(t)
    t = tables.delete_where(t, F.col("id") == 9)
    assert tables.find(t, id=9).isEmpty() and t.count() == 4  # the NULL id stays
    with pytest.raises(ValueError):
        tables.insert_rows(t, spark.createDataFrame([(1,)], "other long"))


def test_filters_are_values_not_sql(spark):
    t = spark.createDataFrame([("x' OR '1'='1",), ("y",)], "name string")
    assert tables.find(t, name="x' OR '1'='1").count() == 1
    assert tables.find(t, name="' OR '1'='1").count() == 0


def test_pages(spark):
    t = spark.range(25)
    assert [r["id"] for r in tables.page(t, ["id"], 10, 20).collect()] == [20, 21, 22, 23, 24]
    assert tables.page_total(t).first()["total"] == 25


def test_replace_and_upsert_catalog_table(spark):
    tables.drop_table(spark, "people")
    assert tables.upsert_table(target(spark), "people", ["id"]).count() == 4
    tables.upsert_table(spark.createDataFrame([(1, "A", NEW), (7, "g", NEW)], SCHEMA), "people", ["id"], "updated")
    assert {r["id"]: r["name"] for r in spark.table("people").collect()} == {1: "A", 2: "b", 3: "c", None: "n", 7: "g"}
    assert tables.truncate_table(spark, "people").count() == 0


def test_archive_then_prune(spark):
    tables.drop_table(spark, "daily")
    tables.drop_table(spark, "daily_archive")
    # 1 January, 31 January, 2 March, 1 April, 1 May, ...; the cutoff is 1 May.
    days = [(i, date(2026, 1, 1) + timedelta(days=30 * i)) for i in range(8)]
    tables.write_table(spark.createDataFrame(days, "id long, day date"), "daily", comment="it's daily")
    first = tables.archive_and_prune(spark, "daily", "daily_archive", "day", 3, "2026-08-01")
    assert first["pruned"] and first["old_rows"] == spark.table("daily_archive").count() == 4
    assert sorted(r["id"] for r in spark.table("daily").collect()) == [4, 5, 6, 7]
    again = tables.archive_and_prune(spark, "daily", "daily_archive", "day", 3, "2026-08-01")
    assert again["old_rows"] == 0 and not again["pruned"]


def test_archive_keeps_rows_that_share_a_key(spark):
    for name in ("shared", "shared_archive"):
        tables.drop_table(spark, name)
    old, new = date(2020, 1, 1), date(2026, 7, 1)
    schema = "id long, note string, day date"
    rows = [(1, "first", old), (1, "second", old), (None, "no key", old), (2, "twice", old), (2, "twice", old), (3, "new", new)]
    tables.write_table(spark.createDataFrame(rows, schema), "shared")
    tables.write_table(spark.createDataFrame([(1, "earlier", old)], schema), "shared_archive")
    assert tables.archive_and_prune(spark, "shared", "shared_archive", "day", 3, "2026-08-01")["pruned"]
    kept = sorted(r["note"] for r in spark.table("shared_archive").collect())
    assert kept == ["earlier", "first", "no key", "second", "twice", "twice"]
    assert [r["note"] for r in spark.table("shared").collect()] == ["new"]


def test_replacing_keeps_partitioning_and_comment(spark):
    tables.drop_table(spark, "parted")
    first = spark.createDataFrame([(1, "a", "x"), (2, "b", "y")], "id long, name string, part string")
    tables.write_table(first, "parted", partition_by=["part"], comment="by part")
    tables.upsert_table(spark.createDataFrame([(2, "B", "y"), (3, "c", "z")], first.schema), "parted", ["id"])
    assert tables._layout(spark, "parted") == (["part"], "parquet", "by part")
    assert {(r["id"], r["name"]) for r in spark.table("parted").collect()} == {(1, "a"), (2, "B"), (3, "c")}
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith("parted_")]


def files_of(spark, name):
    return {f: os.stat(unquote(urlparse(f).path)).st_mtime_ns for f in spark.table(name).inputFiles()}


def parted(spark, name):
    tables.drop_table(spark, name)
    rows = [(i, f"n{i}", p) for i, p in enumerate(["a", "b", "c d:e", "it's", None, "f"])]
    df = spark.createDataFrame(rows, "id long, name string, part string")
    return tables.write_table(df, name, partition_by=["part"])


def content(spark, name):
    return {r["id"]: (r["name"], r["part"]) for r in spark.table(name).collect()}


CHANGES = [(0, "new", "a"), (2, "new", "f"), (4, "new", None), (9, "new", "z"), (3, "new", "it's")]
CHANGED = {0: ("new", "a"), 1: ("n1", "b"), 2: ("new", "f"), 3: ("new", "it's"), 4: ("new", None), 5: ("n5", "f"), 9: ("new", "z")}


def test_upsert_leaves_other_partitions_alone(spark):
    parted(spark, "touch")
    before = files_of(spark, "touch")
    tables.upsert_table(spark.createDataFrame(CHANGES, "id long, name string, part string"), "touch", ["id"])
    assert content(spark, "touch") == CHANGED
    after = files_of(spark, "touch")
    same = {f for f in before if after.get(f) == before[f]}
    assert len(same) == 1 and "part=b" in same.pop()
    assert not any("part=c" in f for f in after)  # its only row moved to another partition
    tables.upsert_table(spark.createDataFrame([(1, "again", "b")], "id long, name string, part string"), "touch", ["id", "part"])
    assert content(spark, "touch") == CHANGED | {1: ("again", "b")}
    tables.upsert_table(spark.createDataFrame([], "id long, name string, part string"), "touch", ["id"])
    assert content(spark, "touch") == CHANGED | {1: ("again", "b")}
    tables.drop_table(spark, "touch")
    assert content_of_new(spark, "touch") == {0, 1, 2, 3, 4, 5}


def content_of_new(spark, name):
    """A table of the same name can be made again."""
    return {r["id"] for r in parted(spark, name).collect()}


@pytest.mark.parametrize("at", ["UNSET", "SET LOCATION", "DROP IF EXISTS", "SET TBLPROPERTIES", "delete"])
def test_upsert_survives_a_crash_at_every_step(spark, monkeypatch, at):
    parted(spark, "crash")
    source = spark.createDataFrame(CHANGES, "id long, name string, part string")
    before = content(spark, "crash")
    real = type(spark).sql

    def dies(self, text, *args, **kwargs):
        if at in text:
            raise OSError("lost")
        return real(self, text, *args, **kwargs)

    def dies_deleting(*_):
        raise OSError("lost")

    with monkeypatch.context() as m:
        m.setattr(type(spark), "sql", dies)
        if at == "delete":
            m.setattr(tables, "delete_path", dies_deleting)
        with pytest.raises(OSError):
            tables.upsert_table(source, "crash", ["id"])
    spark.catalog.refreshTable("crash")
    half = content(spark, "crash")
    assert all(half.get(i) in (before.get(i), CHANGED.get(i)) for i in half)
    tables.upsert_table(source, "crash", ["id"])
    assert content(spark, "crash") == CHANGED
    assert not tables.finish_change(spark, "crash")


def test_replacing_is_one_change_of_the_catalog(spark, monkeypatch):
    tables.drop_table(spark, "one")
    tables.write_table(spark.range(5), "one", comment="kept")

    def dies(*_):
        raise OSError("lost")

    with monkeypatch.context() as m:
        m.setattr(tables, "delete_path", dies)
        with pytest.raises(OSError):
            tables.replace_table(spark.table("one").where("id > 2"), "one")
    assert sorted(r["id"] for r in spark.table("one").collect()) == [3, 4]
    tables.replace_table(spark.table("one").where("id > 3"), "one")
    assert spark.table("one").count() == 1 and tables._layout(spark, "one")[2] == "kept"
    tables.replace_table(spark.range(3).withColumnRenamed("id", "other"), "one")
    assert spark.table("one").columns == ["other"] and spark.table("one").count() == 3
    tables.drop_table(spark, "one")
    assert tables.write_counted(spark.range(7), "one")[1] == 7
    assert tables.write_counted(spark.range(2), "one")[1] == 2 and spark.table("one").count() == 9


def test_rows_that_turn_up_during_archiving_survive(spark):
    for name in ("busy", "busy_archive"):
        tables.drop_table(spark, name)
    schema, old = "id long, tags map<string,int>, day date", date(2020, 1, 1)
    tables.write_table(spark.createDataFrame([(1, {"a": 1}, old), (1, {"a": 1}, old), (2, None, date(2026, 7, 1))], schema), "busy")

    def write(rows):
        rows.write.mode("append").saveAsTable("busy_archive")
        late = [(1, {"a": 1}, old), (3, {}, old)]
        spark.createDataFrame(late, schema).write.mode("append").saveAsTable("busy")

    assert tables.archive_and_prune(spark, "busy", "busy_archive", "day", 3, "2026-08-01", write=write)["pruned"]
    assert sorted(r["id"] for r in spark.table("busy_archive").collect()) == [1, 1]
    assert sorted(r["id"] for r in spark.table("busy").collect()) == [1, 2, 3]


def test_batches_never_split_rows_that_tie(spark):
    rows = [(i, [1, 2, 2, 2, 2, 3, None, 4][i]) for i in range(8)]
    source = spark.createDataFrame(rows, "id long, at long")
    loaded = source.limit(0)
    for _ in range(5):
        batch = increment(source, spark.createDataFrame(loaded.collect(), source.schema), "at", limit=3)
        loaded = loaded.unionByName(spark.createDataFrame(batch.collect(), source.schema))
    assert sorted(r["id"] for r in loaded.collect()) == list(range(8))


def test_flows_backfill_once_then_increment(spark):
    for name in ("closing", "closing_flows"):
        tables.drop_table(spark, name)
    source = [spark.createDataFrame([(1, OLD), (2, SAME)], "id long, created timestamp")]
    both = [
        AppendFlow("backfill", lambda _: source[0], "src", once=True),
        AppendFlow("recurring", lambda since: source[0].where(F.col("created") > F.lit(since)), "src", watermark="created"),
    ]
    assert run_flows(spark, "closing", both) == ["backfill", "recurring"]
    assert spark.table("closing").count() == 2
    source[0] = source[0].union(spark.createDataFrame([(3, NEW)], "id long, created timestamp"))
    assert run_flows(spark, "closing", both) == ["recurring"]
    assert sorted(r["id"] for r in spark.table("closing").collect()) == [1, 2, 3]
    assert high_watermark(spark, "closing", "created") == NEW
    assert high_watermark(spark, "no_such_table", "created") == "1900-01-01 00:00:00"


@pytest.mark.parametrize("dies_at", ["before the rows", "after the rows"])
@pytest.mark.parametrize("by_batch", [True, False])
def test_flows_repeat_after_a_crash_without_doubling(spark, monkeypatch, dies_at, by_batch):
    for name in ("calls", "calls_flows"):
        tables.drop_table(spark, name)
    rows = spark.createDataFrame([(1, OLD), (2, SAME)], "id long, created timestamp")
    if not by_batch:
        tables.write_table(add_batch_columns(rows.limit(0), "src"), "calls")
    flow = AppendFlow("backfill", lambda _: rows, "src", once=True)
    real = flows._log

    def dies(spark, target, name, batch, state):
        if state == flows.DONE and dies_at == "after the rows":
            raise OSError("lost")
        real(spark, target, name, batch, state)
        if state == flows.BEGUN and dies_at == "before the rows":
            raise OSError("lost")

    with monkeypatch.context() as m:
        m.setattr(flows, "_log", dies)
        with pytest.raises(OSError):
            run_flows(spark, "calls", [flow])
    if spark.catalog.tableExists("calls"):
        assert flows.committed(spark, "calls").count() == 0
    assert run_flows(spark, "calls", [flow]) == ["backfill"]
    assert sorted(r["id"] for r in flows.committed(spark, "calls").collect()) == [1, 2]
    assert sorted(r["id"] for r in spark.table("calls").collect()) == [1, 2]
    assert run_flows(spark, "calls", [flow]) == []


def test_increment_with_overlap_finds_late_rows(spark):
    t = spark.createDataFrame([(1, SAME), (2, NEW)], "id long, ts timestamp")
    s = spark.createDataFrame([(1, SAME), (2, NEW), (3, NEW), (4, NEW + timedelta(1))], "id long, ts timestamp")
    assert sorted(r["id"] for r in increment(s, t, "ts").collect()) == [4]
    assert sorted(r["id"] for r in increment(s, t, "ts", timedelta(hours=1), ["id"]).collect()) == [3, 4]
    assert sorted(r["id"] for r in increment(s, t.limit(0), "ts").collect()) == [1, 2, 3, 4]


def test_sources_fall_back(spark, tmp_path):
    path = str(tmp_path / "x.csv")
    with open(path, "w") as f:
        f.write('id,note\n00123,"two\nlines, ""quoted"""\n')
    df, origin = resolve(spark, "no_such_table", path, read_csv_text)
    assert origin.startswith("FILE:") and tuple(df.first()) == ("00123", 'two\nlines, "quoted"')
    assert optional_table(spark, "no_such_table", ["a"]) is None
    tables.write_table(spark.createDataFrame([("2026-01-01", 5.0)], "d string, t double"), "ship_b")
    usable = [{"table": "no_such_table", "date_col": "d", "ton_col": "t"}, {"table": "ship_b", "date_col": "d", "ton_col": "t"}]
    assert tuple(first_usable(spark, usable).first()) == (date(2026, 1, 1), 5.0, False, "ship_b.t")
    intake = spark.createDataFrame([(date(2026, 1, 1), 100.0)], "production_date date, cp_intake_ton double")
    assert first_usable(spark, usable[:1], intake, 0.985).first()["is_estimated"]
    assert first_usable(spark, []).count() == 0
    assert with_columns_of(df, {"id": "string", "x": "double"}).dtypes == [("id", "string"), ("x", "double")]
    batch = add_batch_columns(spark.range(50), "src")
    assert batch.select("_batch_id").distinct().count() == 1


def test_jdbc_retry_and_query_text():
    calls, waits = [], []

    def read(ok_at):
        calls.append(1)
        if len(calls) < ok_at:
            raise OSError("down")
        return "frame"

    assert read_with_retry(lambda: read(3), 3, 10, 2.0, probe=lambda df: df, sleep=waits.append) == "frame"
    assert waits == [10, 20.0]
    calls.clear()
    with pytest.raises(RetriesExhausted) as failure:
        read_with_retry(lambda: read(9), 3, 0, probe=lambda df: df, sleep=lambda s: None)
    assert isinstance(failure.value.__cause__, OSError) and len(calls) == 3
    assert newer_than("t", "ts", "2026-01-01") == "(SELECT * FROM t WHERE ts > '2026-01-01') AS increment"
    oldest = "SELECT ts AS edge FROM t WHERE ts > '2026-01-01' ORDER BY ts LIMIT 100"
    assert newer_than("t", "ts", "2026-01-01", 100) == (
        f"(SELECT * FROM t WHERE ts > '2026-01-01' AND ts <= (SELECT MAX(edge) FROM ({oldest}) AS oldest)) AS increment"
    )
    options = JdbcSource("jdbc:x", "d", {"user": "u"}, "id", "1", "9", 4).options("q")
    assert options["numPartitions"] == "4" and options["fetchsize"] == "1000" and options["user"] == "u"


def test_expectations(spark):
    df = spark.createDataFrame([(1.0,), (-1.0,), (None,)], "v double")
    assert [r["v"] for r in quality.expect_or_drop(df, positive="v >= 0").collect()] == [1.0]
    seen = Observation("seen")
    assert quality.expect(df, seen, positive="v >= 0").count() == 3
    assert seen.get == {"rows": 3, "positive": 2}


def test_gate_blocks_only_on_blocking(spark):
    df = spark.range(10)
    bad = F.count_if(F.col("id") > 5)
    warn = quality.Check("w", "silver", "t", quality.WARNING, bad, 0)
    assert quality.gate(quality.check_log(quality.run_checks(df, [warn]))).count() == 1
    block = quality.Check("b", "silver", "t", quality.BLOCKING, bad, 0)
    with pytest.raises(quality.BlockingCheckFailed, match="b=4.0"):
        quality.gate(quality.check_log(quality.run_checks(df, [warn, block])))


def test_profile(spark):
    df = spark.createDataFrame([(1, None), (1, None), (2, "x")], "a int, b string")
    assert {r["column_name"]: r["null_count"] for r in quality.null_profile(df).collect()} == {"a": 0, "b": 2}
    assert tuple(quality.table_profile(df, "t").first()) == ("t", 3, 2, 1)
