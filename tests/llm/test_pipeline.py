"""The whole pipeline against plain Python and SQL."""

import hashlib
import os
from collections import Counter

import duckdb
import pandas as pd
import pytest

import corpus_pipeline
from tests.llm import test_minmax, test_suffix
from tests.llm.conftest import number_words
from tonflow.llm.queries import OP4_SQL

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="needs the given tables")


def similarity(a, b):
    a, b = ({tuple(w[i : i + 5]) for i in range(len(w) - 4)} for w in (a.lower().split(), b.lower().split()))
    return len(a & b) / len(a | b)


def changed(text, low, high):
    """The text with as many words replaced as make its similarity lie between the bounds."""
    words = text.split(" ")
    for at in range(10, len(words), 6):
        words[at] = number_words(7_000_000 + at, 1)
        if low <= similarity(text, " ".join(words)) < high:
            return " ".join(words)
    raise ValueError("too short")


def given(spark, folder, planted):
    """Folder with the given tables and what ``planted`` makes of a clean text as further documents."""
    docs, labels = (spark.read.parquet(f"{FOLDER}/{t}.parquet") for t in ("documents", "labels"))
    good = docs.join(labels.where("quality = 1"), "doc_id").where("n_chars between 1500 and 4000 and lang = 'en'")
    text = good.orderBy("doc_id").first().text
    rows = [(i, t, "en", "planted", len(t)) for i, t in planted(text)]
    docs.unionByName(spark.createDataFrame(rows, docs.schema)).write.parquet(f"{folder}/documents.parquet")
    labels.write.parquet(f"{folder}/labels.parquet")
    return folder, len(rows)


def expected(rows):
    """How often each text leaves the pipeline, from the (id, text, source) that quality has kept."""
    rows = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, hashlib.md5(r[1].encode()).hexdigest()))
    single = {}
    for row, (_, component) in zip(rows, components([r[:2] for r in rows]), strict=True):
        single.setdefault(component, row)
    kept = list(single.values())
    cut = [x[3].decode() for x in test_suffix.brute([r[1] for r in kept], 200)]
    documents = pd.DataFrame({"doc_id": pd.array([r[0] for r in kept], "Int64"), "text": cut, "source": [r[2] for r in kept]})
    with duckdb.connect() as db:
        db.register("documents", documents)
        mixed = db.execute(f"SELECT doc_id, size, taken FROM ({OP4_SQL})").fetchall()
    passes = {doc: (taken > 0) + (taken > size) for doc, size, taken in mixed}
    texts = zip(kept, cut, strict=True)
    return +Counter({hashlib.sha256(t.encode()).hexdigest(): passes[r[0]] for r, t in texts})


def components(rows):
    """(row, number of its component) by comparing all pairs; ids may be repeated or null."""
    numbered = test_minmax.brute([(i, t) for i, (_, t) in enumerate(rows)], percent=80)
    return sorted((i, c) for i, _, c in numbered)


def check(spark, folder, planted):
    folder, n = given(spark, str(folder), planted)
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    kept = corpus_pipeline.quality(spark, docs, folder).select("doc_id", "text", "source").collect()
    assert sum(r.source == "planted" for r in kept) == n
    got = Counter(r.decoded_sha256 for r in corpus_pipeline.run(spark, folder).collect())
    assert got == expected([tuple(r) for r in kept])


def test_links_from_80_percent(spark, tmp_path):
    def planted(text):
        return [(9_000_001, changed(text, 0.8, 0.84)), (9_000_002, changed(text, 0.7, 0.79))]

    check(spark, tmp_path, planted)


def test_one_row_of_each_group(spark, tmp_path):
    """Rows read in twice, copies without an id, and different similar texts with one id."""

    def planted(text):
        words = text.split(" ")
        other, third = " ".join(words[::-1]), " ".join(words[1::2] + words[::2])
        twice = [(9_000_001, other), (9_000_001, other), (9_000_002, other)]
        return [*twice, (None, third), (None, third), (9_000_003, text), (9_000_003, changed(text, 0.9, 0.99))]

    check(spark, tmp_path, planted)


def test_one_row_whatever_the_other_columns(spark, edges):
    twice = edges.unionByName(edges.withColumn("n_chars", edges.n_chars + 1)).unionByName(edges)
    kept = corpus_pipeline.near_duplicates(spark, twice, FOLDER)
    rows = [(r.doc_id, r.n_chars) for r in kept.collect()]
    assert kept.columns == edges.columns
    assert sorted(rows, key=str) == sorted([(1, 1), (3, None), (None, 5), (4, 0), (5, 3), (6, kept.where("doc_id = 6").first().n_chars),
                                            (7, 7), (8, 13), (9, None)], key=str)
