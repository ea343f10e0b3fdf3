from pyspark.sql import functions as F

from tests.llm.conftest import number_words
from tonflow.llm import curriculum


def test_targets_passes_and_positions(spark):
    docs = [(i, number_words(0, 10 + i % 7), "abc"[i % 3] if i % 10 else None) for i in range(400)]
    docs += [(1000 + i, number_words(0, 3), "tiny") for i in range(3)]
    df = spark.createDataFrame(docs, "doc_id long, text string, source string")
    rows = curriculum.mix(df, carry=("doc_id", "source")).select("doc_id", "source", "mix.*").collect()
    assert len(rows) == len(docs)
    total = sum(r["size"] for r in rows)
    taken, target, sizes = {}, {}, {}
    for r in rows:
        assert r.taken <= 2 * r["size"] and r.taken == sum(p.words for p in r.placements)
        taken[r.source] = taken.get(r.source, 0) + r.taken
        target[r.source], sizes[r.source] = r.target, r.source_size
    assert abs(sum(target.values()) - 1.5 * total) < 1e-6 * total
    for s in target:
        assert int(target[s]) == taken[s] and target[s] <= 2 * sizes[s] + 1e-9
    weight = dict(zip(sorted(x for x in target if x) + [None], [5, 2, 1, 5, 2], strict=True))
    free = [s for s in target if target[s] < 2 * sizes[s] - 1e-9]
    assert len({round(target[s] / weight[s], 6) for s in free}) == 1
    level = target[free[0]] / weight[free[0]]
    assert all(2 * sizes[s] <= level * weight[s] + 1e-6 for s in target if s not in free)
    again = curriculum.mix(df.repartition(5), carry=("doc_id", "source")).select("doc_id", "source", "mix.*").collect()
    assert sorted(map(str, rows)) == sorted(map(str, again))


def test_order_follows_the_schedule(spark):
    df = spark.createDataFrame([(i, number_words(0, 5), "ab"[i % 2]) for i in range(2000)], "doc_id long, text string, source string")
    mixed = curriculum.mix(df, carry=("doc_id", "source"), weights=(1.0, 1.0), slopes=(-0.8, 0.8))
    order = curriculum.training_order(mixed)
    place = [r.position for r in order.collect()]
    assert place == sorted(place) and 0 <= place[0] and place[-1] < 1
    early = {r.source: r.n for r in order.where("position < 0.1").groupBy("source").agg(F.count("*").alias("n")).collect()}
    assert early["a"] > 5 * early["b"]  # rates 1.72 and 0.28


def test_ties_have_an_order(spark):
    """Sources of the same sizes and schedule give the same positions; reruns agree on the order."""
    docs = [(i, number_words(0, 5), "abcd"[i % 4]) for i in range(80)] + [(0, number_words(9, 5), "a"), (None, "x y", "b")]
    df = spark.createDataFrame(docs, "doc_id long, text string, source string")
    orders = []
    for rows in (df, df.orderBy(F.rand(3)).repartition(7)):
        mixed = curriculum.mix(rows, carry=("doc_id", "source", "text"), weights=(1.0,), slopes=(0.0,))
        orders.append([tuple(r) for r in curriculum.training_order(mixed).collect()])
    assert orders[0] == orders[1] and len({r[-1] for r in orders[0]}) < len(orders[0])


def test_parts_do_not_change_the_mix(spark, monkeypatch):
    df = spark.createDataFrame([(i, number_words(0, 1 + i % 9), "ab"[i % 3 == 0]) for i in range(500)], "doc_id long, text string, source string")
    one = curriculum.mix(df).select("doc_id", "mix.taken", "mix.placements").collect()
    monkeypatch.setattr(curriculum, "ROWS_PER_PART", 3)
    assert sorted(map(str, one)) == sorted(map(str, curriculum.mix(df).select("doc_id", "mix.taken", "mix.placements").collect()))


def test_edges(edges, none):
    rows = curriculum.mix(edges, carry=tuple(edges.columns))
    assert rows.count() == 11 and rows.where("mix.size = 0 and mix.taken = 0").count() == 3
    order = curriculum.training_order(rows)
    assert set(edges.columns) < set(order.columns)
    assert curriculum.mix(none).count() == 0
    assert curriculum.mix(edges.where("text is null")).select("mix.taken").first()[0] == 0
