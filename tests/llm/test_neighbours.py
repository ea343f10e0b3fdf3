import numpy as np

from tonflow.llm import neighbours

SCHEMA = "vec_id long, embedding array<float>, size string"


def product(a, b):
    total = 0.0
    for x, y in zip(a, b, strict=True):
        total += float(x) * float(y)
    return total


def brute(vectors, ids, k):
    out = {}
    for q in ids:
        scores = sorted((-product(vectors[q], v), i) for i, v in vectors.items() if i != q)
        out[q] = [(i, -s) for s, i in scores[:k]]
    return out


def test_same_as_brute_force_with_ties_and_unusable_vectors(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "ROWS_PER_BLOCK", 100)
    monkeypatch.setattr(neighbours, "QUERIES_PER_BLOCK", 16)
    random = np.random.default_rng(5)
    middle = random.standard_normal((5, 24))
    vectors = {i: (middle[i % 5] + 0.4 * random.standard_normal(24)).astype(np.float32).tolist() for i in range(600)}
    for i in range(40, 60):
        vectors[i] = vectors[40]  # ties
    rows = [(i, v, "own") for i, v in vectors.items()] + [(3, vectors[3], "own")]
    inf, nan = float("inf"), float("nan")
    rows += [(1000, None, ""), (1020, [0.0] * 24, ""), (1040, [nan] * 24, ""), (1060, [1.0] * 23 + [inf], ""),
             (1080, [1.0] * 23 + [None], ""), (1100, [1.0] * 7, ""), (None, vectors[1], ""), (1120, [], "")]
    index, mean = neighbours.build_index(spark.createDataFrame(rows, SCHEMA))
    assert index.count() == 600
    found = neighbours.search(index, mean, index.where("id % 20 = 0"), k=20)
    got = {}
    for r in found.orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
    want = brute(vectors, [i for i in vectors if i % 20 == 0], 20)
    assert got.keys() == want.keys()
    hits = sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want)
    assert hits >= 0.99 * 20 * len(want)
    assert got[0] == want[0] and got[40] == want[40]


def test_fewer_candidates_and_empty(spark):
    few = spark.createDataFrame([(0, [1.0, 0.0], ""), (1, [0.5, 0.5], ""), (2, [1.0, 0.0], "")], SCHEMA)
    index, mean = neighbours.build_index(few)
    rows = neighbours.search(index, mean, index.where("id = 0")).orderBy("rank").collect()
    assert [(r.vec_id, r.score) for r in rows] == [(2, 1.0), (1, 0.5)]
    index, mean = neighbours.build_index(few.limit(0))
    assert neighbours.search(index, mean, index).count() == 0
