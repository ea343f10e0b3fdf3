"""Registered queries over the given tables, and the pipeline."""

import os

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tonflow.llm.queries import ORACLES, QUERIES
from verification.check import connect, same

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="needs the given tables")


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_rows_as_sql(spark, name):
    assert same(QUERIES[name](spark, FOLDER).toPandas(), connect(FOLDER).execute(ORACLES[name]).df())


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    scored = QUERIES["op3_rule_classifier"](spark, folder).where("held_out").join(labels, "doc_id")
    assert scored.where("predicted = quality").count() >= 0.95 * scored.count()
    named = QUERIES["op9_language"](spark, folder).where("held_out").join(docs.select("doc_id", "lang"), "doc_id")
    assert named.where("lang_pred = lang").count() >= 0.97 * named.count()


def test_pipeline(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "near_duplicates", "repeated_passages", "mixture", "tokens"]
    sizes = [docs.count()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = corpus_pipeline.stored(stage(spark, docs, FOLDER))
        assert out.schema.simpleString() == docs.schema.simpleString(), name
        docs = out
        sizes.append(out.count())
    assert sizes[0] > sizes[1] > sizes[2] == sizes[3] > 0
    last = corpus_pipeline.STAGES[-1][1](spark, docs, FOLDER)
    digests = docs.select(F.sha2(F.coalesce("text", F.lit("")), 256).alias("decoded_sha256"))
    assert last.select("decoded_sha256").exceptAll(digests).isEmpty() and last.count() == docs.count()


def test_pipeline_stages_take_edges_and_empty_tables(spark, edges, none):
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, edges, FOLDER).count() >= 0, name
        assert stage(spark, none, FOLDER).count() == 0, name
