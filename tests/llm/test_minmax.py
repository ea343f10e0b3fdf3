import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.conftest import number_words
from tonflow.llm import minmax


def brute(rows, percent=85):
    """Components by comparing all pairs; (id, set size, component) per row."""
    sets = []
    for _, text in rows:
        w = (text or "").encode().lower().split()
        sets.append({tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    top = list(range(len(rows)))

    def root(x):
        while top[x] != x:
            x = top[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                top[root(i)] = root(j)
    least = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            least[root(i)] = min(least.get(root(i), doc), doc)
    return sorted(
        (((d, len(s), least.get(root(i)) if s else d) for i, ((d, _), s) in enumerate(zip(rows, sets, strict=True)))), key=str
    )


def copies(seed, base_words, count, most_edits):
    """A text and copies of it with words replaced, copies of copies among them."""
    rng = random.Random(seed)
    texts = [number_words(seed * 10_000, base_words).split()]
    for i in range(count):
        words = list(rng.choice(texts[:1] * 3 + texts))
        for _ in range(rng.randint(0, most_edits)):
            words[rng.randrange(len(words))] = number_words(5_000_000 + seed * 1000 + i * 31 + rng.randrange(1000), 1)
        texts.append(words)
    return [" ".join(t) for t in texts]


def run(spark, rows):
    df = minmax.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"))
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in df.collect()), key=str), df


@pytest.mark.parametrize("per_task", [2000, 40])
def test_same_components_as_all_pairs(spark, monkeypatch, per_task):
    monkeypatch.setattr(minmax, "PER_TASK", per_task)
    texts = copies(1, 150, 70, 9) + copies(2, 60, 30, 4) + copies(3, 40, 6, 2) + [number_words(900_000 + 50 * i, 50) for i in range(20)]
    texts += texts[:5] + [texts[0].upper(), "", None, " \n", "one two", "ONE  two", "one two three"]
    random.Random(4).shuffle(texts)
    rows = list(enumerate(texts))
    got, df = run(spark, rows)
    assert got == brute(rows)
    assert df.where("kept").count() == len({c for _, _, c in got})


def test_links_within_a_task_are_those_of_all_pairs():
    rng = np.random.default_rng(7)
    for _ in range(60):
        base = rng.integers(0, 2**60, rng.integers(8, 60), dtype=np.uint64)
        sets = []
        for _ in range(rng.integers(2, 25)):
            own = base[rng.random(len(base)) > rng.choice([0.02, 0.1, 0.25])]
            sets.append(np.unique(np.r_[own, rng.choice(base, 1), rng.integers(0, 2**60, rng.integers(0, 6), dtype=np.uint64)]))
        top = list(range(len(sets)))
        for links in (minmax.spanning_links(sets, 85), None):
            own = list(range(len(sets)))
            pairs = links if links is not None else [(i, j) for i in range(len(sets)) for j in range(i)]
            for i, j in pairs:
                both = len(np.intersect1d(sets[i], sets[j]))
                if 100 * both >= 85 * (len(sets[i]) + len(sets[j]) - both):
                    a, b = own[i], own[j]
                    own = [min(a, b) if x in (a, b) else x for x in own]
                else:
                    assert links is None
            top = own if links is not None else top
        assert top == own


def test_prefixes_of_similar_sets_meet():
    rng = np.random.default_rng(9)
    for _ in range(3000):
        hub = np.unique(rng.integers(0, 10_000, rng.integers(5, 60), dtype=np.uint64))
        a = np.unique(np.r_[hub[rng.random(len(hub)) > 0.2], rng.integers(0, 10_000, rng.integers(1, 14), dtype=np.uint64)])
        b = np.unique(np.r_[a[rng.random(len(a)) > 0.05], rng.integers(0, 10_000, rng.integers(0, 2), dtype=np.uint64)])
        if not len(b) or np.array_equal(a, b):
            continue

        def linked(x, y):
            both = len(np.intersect1d(x, y))
            return 100 * both >= 85 * (len(x) + len(y) - both)

        if linked(a, b) and not (linked(a, hub) and linked(b, hub)) and not any(np.array_equal(x, hub) for x in (a, b)):
            first, second = (minmax.difference_prefix(x, hub, 85) for x in (a, b))
            assert len(np.intersect1d(first, second))


def test_edges(spark, edges, none):
    out = minmax.near_duplicates(edges, carry_key=True)
    rows = {}
    for r in out.collect():
        rows.setdefault(r.doc_id, []).append(r)
    assert sum(map(len, rows.values())) == 11
    assert [r.component_id for r in rows[1]] == [1, 1] and all(r.kept for r in rows[1])
    assert rows[2][0].component_id == 1 and not rows[2][0].kept
    assert rows[None][0].component_id is None and rows[None][0].kept
    assert [(rows[i][0].n_shingles, rows[i][0].component_id) for i in (3, 4, 5)] == [(0, 3), (0, 4), (0, 5)]
    assert rows[6][0].n_shingles == 19_996
    assert minmax.near_duplicates(none).count() == 0


def test_labels_travel_along_a_chain(spark):
    chain = [(f"{i:03d}".encode(), f"{i + 1:03d}".encode()) for i in range(40)] + [(b"x", b"y")]
    labels = minmax.components(spark.createDataFrame(chain, "a binary, b binary"))
    assert labels.groupBy(F.col("label").cast("string")).count().count() == 2
    assert labels.count() == 43


@pytest.mark.parametrize("per_task", [2000, 60])
def test_large_group_of_near_copies_ends_in_two_rounds(spark, monkeypatch, per_task):
    """Many copies of one text, most of them not similar enough to it, some similar to each other."""
    monkeypatch.setattr(minmax, "PER_TASK", per_task)
    rounds = []
    real = minmax.compared
    monkeypatch.setattr(minmax, "compared", lambda *a: rounds.append(1) or real(*a))
    rows = list(enumerate(copies(11, 120, 400, 8)))
    got, _ = run(spark, rows)
    assert got == brute(rows)
    assert len(rounds) <= 2
