"""Slot-wise scans against plain Python on random rows, one key holding a third of them."""

import random
from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from tonflow.operators import ordered
from tonflow.operators.ordered import Leg

START = datetime(2026, 1, 1)


def random_rows(seed, n=300, null_every=29):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        key = "hot" if rng.random() < 0.35 else rng.choice(["a", "b", "c", None])
        ts = None if i % null_every == 5 else START + timedelta(seconds=rng.randrange(0, 3 * 86400, 60))
        rows.append((i, key, ts, rng.choice([None, 1.0, 2.0, 3.0, 5.0, 8.0])))
    return rows


SCHEMA = "id long, k string, ts timestamp, v double"


@pytest.mark.parametrize("minutes", [5, 240, 100_000])
def test_previous_row(spark, minutes):
    rows = random_rows(1)
    df = spark.createDataFrame(rows, SCHEMA)
    got = ordered.previous_row(df, ["k"], ["ts", "id"], ["id", "v"], ordered.time_slot("ts", minutes))
    got = {r["id"]: (tuple(r["previous"]) if r["previous"] else None) for r in got.collect()}
    want = {}
    for key in {r[1] for r in rows}:
        placed = sorted((r for r in rows if r[1] == key and r[2]), key=lambda r: (r[2], r[0]))
        for before, now in zip([None, *placed], placed):
            want[now[0]] = (before[0], before[3]) if before else None
    want |= {r[0]: None for r in rows if r[2] is None}
    assert got == want


def test_counter_delta_resets_gaps_and_ties(spark):
    t = [START + timedelta(seconds=30 * i) for i in range(6)]
    rows = [("p", t[0], 10.0), ("p", t[1], 14.0), ("p", t[2], None), ("p", t[3], 20.0), ("p", t[4], 3.0), ("p", t[5], 3.0)]
    df = spark.createDataFrame(rows, "loc string, ts timestamp, total double")
    got = ordered.counter_delta(df, ["loc"], "ts", "total", "d", "s", slot_minutes=1).orderBy("ts").collect()
    assert [r["d"] for r in got] == [None, 4.0, None, None, None, 0.0]
    assert [r["s"] for r in got] == [None, 30, 30, 30, 30, 30]


def test_drop_repeats(spark):
    def at(m):
        return START + timedelta(minutes=m)

    rows = [
        (1, "t", at(0), at(5)), (2, "t", at(19), None), (3, "t", at(39), None), (4, "t", at(60), None),
        (5, "t", at(70), at(75)), (6, None, at(71), None), (7, None, at(72), None), (8, "t", None, None), (9, "u", at(1), None),
    ]
    df = spark.createDataFrame(rows, "id long, k string, ts timestamp, out timestamp")
    kept = ordered.drop_repeats(df, ["k"], "ts", "out", 20, ["id"], slot_minutes=10)
    # 2 and 3 follow within 20 minutes (3 follows the dropped 2); 4 comes 21 minutes later.
    assert sorted(r["id"] for r in kept.collect()) == [1, 4, 5, 6, 7, 8, 9]


@pytest.mark.parametrize("minutes", [7, 60, 100_000])
@pytest.mark.parametrize("direction", ["backward", "forward"])
def test_nearest_match(spark, minutes, direction):
    left, right = random_rows(2), random_rows(3, null_every=31)
    l = spark.createDataFrame(left, SCHEMA)
    r = spark.createDataFrame(right, "rid long, k string, rts timestamp, rv double")
    got = ordered.asof_join(l, r, ["k"], "ts", "rts", "rid", direction, 2.0, ["rid", "rts"], slot_minutes=minutes)
    got = {x["id"]: x["rid"] for x in got.collect()}
    want = {}
    for i, key, ts, _ in left:
        sign = 1 if direction == "backward" else -1
        near = [
            ((ts - rts) * sign, rid) for rid, rk, rts, _ in right
            if ts and rts and key is not None and rk == key and timedelta(0) <= (ts - rts) * sign <= timedelta(hours=2)
        ]
        want[i] = min(near)[1] if near else None
    assert got == want


def test_several_legs_and_condition_keep_every_left_row(spark):
    left = spark.createDataFrame(random_rows(4), SCHEMA)
    right = spark.createDataFrame(random_rows(5), "rid long, k string, rts timestamp, rv double")
    legs = [
        Leg("before", right, "rts", "backward", "rid", ["rid"]),
        Leg("after", right, "rts", "forward", "rid", ["rid"], when=F.col("v") > 2),
    ]
    both = ordered.match_nearest(left, ["k"], "ts", legs, 8.0, 30)
    rows = both.collect()
    assert sorted(r["id"] for r in rows) == list(range(300))
    assert all(r["after"] is None for r in rows if r["v"] is None or r["v"] <= 2)
    alone = ordered.asof_join(left, right, ["k"], "ts", "rts", "rid", "backward", 8.0, ["rid"], slot_minutes=500)
    assert {r["id"]: r["before"]["rid"] if r["before"] else None for r in rows} == {r["id"]: r["rid"] for r in alone.collect()}


@pytest.fixture
def many_slots(spark):
    """Every shuffle partition is a slot."""
    names = {"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.shuffle.partitions": "13"}
    before = {n: spark.conf.get(n) for n in names}
    for n, value in names.items():
        spark.conf.set(n, value)
    yield
    for n, value in before.items():
        spark.conf.set(n, value)


def test_running_total_is_sum_so_far(spark, many_slots):
    rows = [(i, i % 3, float(i)) for i in range(60)]
    df = spark.createDataFrame(rows, "t long, k long, v double")
    got = ordered.running_total(df, ["t"], "v", opening=100.0).orderBy("t").collect()
    so_far = 100.0
    for r in got:
        so_far += r["v"]
        assert abs(r["running_total"] - so_far) < 1e-9
    keyed = ordered.running_total(df, ["t"], "v", ["k"]).where("t = 59").first()
    assert keyed["running_total"] == sum(v for t, k, v in rows if k == 2)


def test_row_numbers_are_a_permutation(spark):
    df = spark.createDataFrame([(float(i * 37 % 101),) for i in range(101)], "x double")
    got = ordered.row_numbers(df, ["x"], "n").collect()
    assert all(r["n"] == r["x"] + 1 for r in got)


def test_slots_are_even_where_rows_crowd(spark, many_slots):
    """Most rows lie within one second of one key; slots follow the rows, not the clock."""
    df = spark.range(20_000).selectExpr("CASE WHEN id % 50 = 0 THEN id ELSE 7 END AS k", "id % 997 AS t", "id")
    sizes = sorted(r["count"] for r in ordered.dealt(df, ["k", "t", "id"]).groupBy("_slot").count().collect())
    assert len(sizes) == 13 and sizes[-1] <= 2 * sizes[len(sizes) // 2]


@pytest.mark.parametrize("between", [False, True])
def test_quantiles_are_exact(spark, many_slots, between):
    rng = random.Random(between)
    rows = [(rng.choice(["a", "b", None]), rng.choice([None, *range(40)])) for _ in range(3000)] + [("c", 5)] * 2 + [("d", None)]
    df = spark.createDataFrame(rows, "k string, v long")
    fractions, names = [0.0, 0.1, 0.25, 0.5, 0.9, 1.0], [f"q{i}" for i in range(6)]
    got = {r["k"]: [float(r[n]) for n in names] for r in ordered.quantiles(df, ["k"], "v", fractions, names, between).collect()}
    assert set(got) == {"a", "b", "c", None}
    for key, found in got.items():
        values = sorted(v for k, v in rows if k == key and v is not None)
        want = np.quantile(values, fractions, method="linear" if between else "inverted_cdf")
        assert found == pytest.approx(list(want))
    alone = ordered.quantiles(df, [], "v", [0.5], ["m"], between).first()["m"]
    assert alone == np.quantile([v for _, v in rows if v is not None], 0.5, method="linear" if between else "inverted_cdf")
    assert ordered.quantiles(df.limit(0), ["k"], "v", [0.5], ["m"], between).count() == 0


def test_maps_may_come_along(spark):
    df = spark.createDataFrame([("a", 1, None, {"x": 1}), ("a", 2, None, {"y": 2})], "k string, t long, ts timestamp, m map<string,int>")
    assert ordered.previous_row(df, ["k"], ["t"], ["t"], F.col("t")).where("previous.t = 1").first()["m"] == {"y": 2}
    right = df.select("k", F.col("ts").alias("rts"), F.col("t").alias("rid"))
    assert ordered.asof_join(df, right, ["k"], "ts", "rts", "rid", "backward", 8.0, ["rid"]).count() == 2


def test_row_numbers_over_slots_of_text_and_nulls(spark, many_slots):
    rows = [(f"{i % 5}" if i % 7 else None, i) for i in range(200)]
    got = ordered.row_numbers(spark.createDataFrame(rows, "a string, b long"), ["a", "b"], "n").collect()
    want = sorted(rows, key=lambda r: (r[0] is not None, r[0] or "", r[1]))
    assert {(r["a"], r["b"]): r["n"] for r in got} == {r: i + 1 for i, r in enumerate(want)}
