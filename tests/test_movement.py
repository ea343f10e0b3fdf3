"""Queue rows from order lines: nothing wide is stored or dealt anew on the way."""

import datetime
import re

import pytest
from pyspark.sql import functions as F

from tonflow.plans import movement
from tonflow.sources import session
from verification import cases, inputs


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    home = tmp_path_factory.mktemp("queue")
    day = datetime.date(2024, 3, 1)
    orders = [(k, day + datetime.timedelta(days=k % 9), [None, "F", "O", "P"][k % 4], "1-URGENT") for k in range(60)]
    lines = [(k % 70, k % 7 + 1, k % 11, k % 13, float(k % 50), "ANR"[k % 3], "FO"[k % 2], "unused") for k in range(400)]
    lines += [(None, 1, 1, 1, 1.0, "A", "F", "unused"), *lines[:3]]
    spark.createDataFrame(orders, "o_orderkey long, o_orderdate date, o_orderstatus string, o_orderpriority string").write.parquet(f"{home}/orders.parquet")
    kinds = "l_orderkey long, l_linenumber int, l_suppkey long, l_partkey long, l_quantity double, l_returnflag string, l_linestatus string, l_comment string"
    spark.createDataFrame(lines, kinds).write.parquet(f"{home}/lineitem.parquet")
    return str(home)


@pytest.mark.parametrize("name", ["movement_silver", "movement_exceptions", "vehicle_summary_hourly", "movement_status_share"])
def test_only_the_given_tables_are_read(spark, folder, name):
    df = cases.QUERIES[name](spark, folder)
    # A stored copy of the raw rows, and for exceptions one of the cleaned rows, was read before.
    assert all(path.startswith(f"file://{folder}/") for path in df.inputFiles())
    assert df.count() > 0


def test_exceptions_are_the_rows_that_need_attention(spark, folder):
    silver = [r.asDict() for r in cases.QUERIES["movement_silver"](spark, folder).collect()]
    found = cases.QUERIES["movement_exceptions"](spark, folder).collect()
    wanted = [
        r for r in silver
        if r["data_quality_status"] != "valid" or r["vehicle_movement_status"] != "IN_OUT_COMPLETED"
        or r["is_anomaly"] == "true" or r["is_anomaly_lane"] == "true"
    ]
    assert 0 < len(wanted) < len(silver)
    shared = ["transaction_date", "queue_name", "lane_id_value", "truck_id_value", "vehicle_movement_status", "tonnage_value", "data_quality_status"]
    rows = lambda got: sorted(str([r[c] for c in shared]) for r in got)
    assert rows(found) == rows(wanted)


@pytest.mark.parametrize("broadcast", ["10m", "-1"])
def test_rows_are_dealt_once_by_the_join(spark, folder, capsys, broadcast):
    # -1 stands for large tables: there the rows were dealt twice and sorted twice before, and spilled.
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
    try:
        cases.QUERIES["movement_silver"](spark, folder).explain()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    plan = capsys.readouterr().out
    assert plan.count("Exchange ") == 2 and "RoundRobin" not in plan and "Sort" not in plan


def test_orders_without_a_key_or_read_twice(spark, tmp_path):
    day = datetime.date(2024, 3, 1)
    orders = [(1, day, "F", "1-URGENT")] * 2 + [(2, day, "O", "1-URGENT"), (None, day, "F", "1-URGENT")]
    lines = [(k, i, 1, 1, 1.0, "A", "F") for k in (1, 2, 3, None) for i in (1, 2)]
    spark.createDataFrame(orders, "o_orderkey long, o_orderdate date, o_orderstatus string, o_orderpriority string").write.parquet(f"{tmp_path}/orders.parquet")
    kinds = "l_orderkey long, l_linenumber int, l_suppkey long, l_partkey long, l_quantity double, l_returnflag string, l_linestatus string"
    spark.createDataFrame(lines, kinds).write.parquet(f"{tmp_path}/lineitem.parquet")
    found = cases.QUERIES["movement_silver"](spark, str(tmp_path)).collect()
    assert sorted(r["assignment_id_value"] for r in found) == [11, 11, 12, 12, 21, 22]


@pytest.mark.parametrize("name", ["vehicle_summary_hourly", "vehicle_summary_lane", "vehicle_summary_daily", "vehicle_output_per_plant", "vehicle_kpis"])
def test_no_sums_are_held_beside_distinct_values(spark, folder, capsys, name):
    cases.QUERIES[name](spark, folder).explain()
    # The sums of all other measures were kept with every assignment and every truck before.
    found = re.findall(r"HashAggregate\(keys=\[[^\]]*assignment_id_value[^\]]*\], functions=\[(.*?)\]\)", capsys.readouterr().out)
    assert found and set(found) == {""}


@pytest.mark.parametrize("keys", [(), ("queue_name",), ("queue_name", "port")])
@pytest.mark.parametrize("rows", ["all", "none"])
def test_summaries_equal_one_aggregation(spark, folder, keys, rows):
    raw = movement.movement_silver(inputs.queue_rows(spark, folder)).where(F.lit(rows == "all"))
    # Groups without a key, repeated and missing ids.
    raw = raw.withColumns({"queue_name": F.when(F.col("tonnage_value") < 1040, F.col("queue_name")), "truck_id_value": F.col("truck_id_value") % 3})
    wanted = raw.groupBy(*keys).agg(*[make().alias(f"n_{m}") for m, make in movement.MEASURES.items()])
    found = movement.vehicle_summary(raw, keys, names={m: f"n_{m}" for m in movement.MEASURES})
    assert found.dtypes == wanted.dtypes
    assert sorted(map(str, found.collect())) == sorted(map(str, wanted.collect()))


def test_enough_partitions_to_merge(spark):
    asked, names = spark.conf.get("spark.sql.shuffle.partitions"), session.FIRST_PARTITIONS
    try:
        spark.conf.unset(names)
        session.session_defaults(spark)
        assert spark.conf.get(names) == "200"  # few partitions of a large table spilled before
        spark.conf.set("spark.sql.shuffle.partitions", "600")
        session.session_defaults(spark)
        assert spark.conf.get(names) == "600"
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", asked)
        spark.conf.unset(names)
