"""Whitening against Python integers and numpy, edge rows."""

import math

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tonflow.llm import whitening
from tonflow.llm.queries import QUERIES

SCHEMA = "vec_id long, embedding array<float>, x int, component string, n string"


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 5).flatmap(lambda d: st.lists(st.lists(st.integers(0, 2**62 - 1) | st.integers(0, 9), min_size=d, max_size=d), min_size=1, max_size=90)))
def test_cross_products_are_exact(rows):
    d = len(rows[0])
    exact = [[sum(r[i] * r[j] for r in rows) for j in range(d)] for i in range(d)]
    assert whitening.cross_products(np.array(rows, np.int64)).tolist() == exact


def test_cross_products_of_many_rows():
    y = np.random.default_rng(2).integers(0, 1000, (70_001, 9))
    assert (whitening.cross_products(y) == y.T @ y).all()


def integers(vector):
    return [math.floor(64 * float(np.float32(c))) + 1_000_000 for c in vector]


def check(out, rows):
    """Compare the query's rows with numpy on the distinct integer vectors."""
    xs = [(i, integers(v)) for i, v in rows]
    fit = sorted({tuple(x) for _, x in xs})
    n, d = len(fit), len(fit[0])
    total = [sum(x[j] for x in fit) for j in range(d)]
    centred = np.array([[x[j] - total[j] / n for j in range(d)] for x in fit])
    v = centred.T @ centred / n
    values = np.linalg.eigvalsh(v)[::-1]
    k = min(16, d)
    assert len(out) == k * len(rows)
    deviation = sorted((i, sum((n * x[j] - total[j]) ** 2 for j in range(d))) for i, x in xs)
    assert sorted((r["vec_id"], r["deviation"]) for r in out if r["component"] == 1) == deviation
    assert {r["n"] for r in out} == {n} and len({r["identity_error"] for r in out}) == 1
    by_component = {c: [r for r in out if r["component"] == c] for c in range(1, k + 1)}
    for c, members in by_component.items():
        assert {round(r["explained"], 9) for r in members} == {round(max(values[c - 1], 0) / values.sum(), 9)}
    return {c: {r["vec_id"]: r["whitened"] for r in m} for c, m in by_component.items()}, v, xs, total, n


def test_given_embeddings(spark):
    folder = "/root/testdata/sf0.001"
    rows = [(r[0], r[1]) for r in spark.read.parquet(f"{folder}/embeddings.parquet").select("vec_id", "embedding").collect()]
    out = QUERIES["op13_whitening"](spark, folder).collect()
    found, v, xs, total, n = check(out, rows)
    values, vectors = np.linalg.eigh(v)
    for c in range(1, 17):
        w = (np.array([x for _, x in xs]) - np.array(total) / n) @ vectors[:, -c] / np.sqrt(values[-c])
        mine = np.array([found[c][i] for i, _ in xs])
        assert min(np.abs(mine - w).max(), np.abs(mine + w).max()) < 1e-8
    assert all(r["identity_error"] <= 1e-9 for r in out[:1])


def whitened(spark, rows):
    df = spark.createDataFrame([(i, v, 1, "c", "n") for i, v in rows], SCHEMA)
    vectors = whitening.whole_vectors(df, "vec_id", "embedding", 64.0, 1_000_000)
    distinct = whitening.fit_list(vectors)
    model = whitening.fit(distinct, 64.0, 1_000_000)
    return model, distinct, vectors


def test_edges(spark):
    rng = np.random.default_rng(4)
    good = [(i, [float(np.float32(c)) for c in rng.standard_normal(3)]) for i in range(20)]
    bad = [(90, None), (91, [1.0, None, 2.0]), (92, [1.0, float("nan"), 2.0]), (93, [float("inf"), 0.0, 0.0]), (94, []), (95, [1.0, 2.0])]
    rows = good + good[:5] + [(None, good[0][1]), (77, good[1][1])]
    model, distinct, vectors = whitened(spark, rows + bad)
    assert model.n == len({tuple(integers(v)) for _, v in good}) == 20
    out = whitening.whiten(vectors, model).collect()
    assert len(out) == 3 * len(rows)
    assert whitening.identity_error(distinct, model) < 1e-9
    assert {r["id"] for r in out} == {i for i, _ in rows}


@pytest.mark.parametrize("rows", [[(1, [0.5, 0.25])], [(1, [0.5, 0.25]), (2, [0.5, 0.25])]])
def test_one_distinct_vector_has_no_components(spark, rows):
    model, distinct, vectors = whitened(spark, rows)
    out = whitening.whiten(vectors, model).collect()
    assert [r["whitened"] for r in out] == [None] * (2 * len(rows)) and {r["deviation"] for r in out} == {0}
    assert model.explained == [None, None] and whitening.identity_error(distinct, model) is None


def test_dependent_and_huge_entries(spark):
    rows = [(i, [float(i), float(2 * i), 0.0, 1e15 if i == 3 else float(i % 3)]) for i in range(12)]
    model, distinct, vectors = whitened(spark, rows)
    xs = [r["x"] for r in distinct.collect()]
    d, n = 4, len(xs)
    total = [sum(x[j] for x in xs) for j in range(d)]
    exact = sorted(sum((n * x[j] - total[j]) ** 2 for j in range(d)) for x in xs)
    out = whitening.whiten(vectors, model).where("component = 1").collect()
    assert sorted(int(r["deviation"]) for r in out) == exact
    assert model.useful[0] and not model.useful[3]


def test_no_rows(spark, tmp_path):
    model, _, _ = whitened(spark, [(1, None)])
    assert model is None
    spark.createDataFrame([(1, None)], "vec_id long, embedding array<float>").write.parquet(f"{tmp_path}/embeddings.parquet")
    out = QUERIES["op13_whitening"](spark, str(tmp_path))
    given = QUERIES["op13_whitening"](spark, "/root/testdata/sf0.001")
    assert out.count() == 0 and dict(out.dtypes) == dict(given.dtypes)


def test_result_does_not_depend_on_partitions(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet")
    sums = []
    for parts in (1, 7):
        vectors = whitening.whole_vectors(df.repartition(parts, F.rand(parts)), "vec_id", "embedding", 64.0, 1_000_000)
        model = whitening.fit(whitening.fit_list(vectors), 64.0, 1_000_000)
        sums.append((model.n, model.sums, model.scatter, model.components.tolist()))
    assert sums[0] == sums[1]
