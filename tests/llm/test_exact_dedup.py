"""Exact dedup against plain Python, binary-fuse filters, edge rows."""

import hashlib
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tonflow.llm import exact_dedup
from tonflow.llm.binary_fuse import build

from tests.llm.conftest import DOCUMENTS, edge_rows


def plain(text):
    return "".join(c for c in text or "" if c not in " \t\n\x0b\x0c\r")


def expected(rows):
    groups = defaultdict(list)
    for doc_id, text in rows:
        groups[plain(text)].append((-len(text or ""), doc_id is None, doc_id or 0, doc_id))
    out = []
    for text, members in groups.items():
        members.sort(key=lambda m: m[:3])
        digest = hashlib.sha256(text.encode()).hexdigest()
        out += [(m[3], members[0][3], len(members), i == 0, digest) for i, m in enumerate(members)]
    return sorted(out, key=repr)


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def pairs(rows):
    return [(r[0], r[1]) for r in rows]


@settings(max_examples=30, deadline=None)
@given(st.sets(st.integers(-(2**63), 2**63 - 1), max_size=300), st.sets(st.integers(-(2**63), 2**63 - 1), max_size=300))
def test_filter_never_misses_a_key(keys, others):
    held = build(np.array(sorted(keys), np.int64))
    assert held.may_hold(np.array(sorted(keys), np.int64)).all()
    assert len(held.may_hold(np.array(sorted(others), np.int64))) == len(others)


def test_filter_is_small_and_seldom_wrong():
    rng = np.random.default_rng(5)
    held = build(np.repeat(rng.integers(-(2**63), 2**63 - 1, 100_000), 2))
    assert len(held.fingerprints) * 8 / 100_000 < 10
    assert held.may_hold(rng.integers(-(2**63), 2**63 - 1, 200_000)).mean() < 1.2 / 256


@pytest.mark.parametrize("batches", [1, 2, 4])
def test_edges_in_any_number_of_batches(spark, edges, batches):
    dealt = [edges.where(F.pmod(F.xxhash64("doc_id", "text"), F.lit(batches)) == b) for b in range(batches)]
    assert got(exact_dedup.deduplicate(dealt)) == expected(pairs(edge_rows()))


def test_same_text_in_several_batches_and_hot_copies(spark, monkeypatch):
    monkeypatch.setattr(exact_dedup, "KEYS_PER_BUCKET", 7)
    monkeypatch.setattr(exact_dedup, "KEYS_PER_TASK", 5)
    rows = [(i, f"text {i % 60}" if i % 3 else "the same  everywhere" + " " * (i % 5), "en", "a", 1) for i in range(600)]
    df = spark.createDataFrame(rows, DOCUMENTS)
    dealt = [df.where(f"doc_id % 4 = {b}") for b in (2, 0, 3, 1)]
    assert got(exact_dedup.deduplicate(dealt)) == expected(pairs(rows))


def test_bytes_decide_when_digests_agree(spark, monkeypatch):
    real = F.sha2
    monkeypatch.setattr(F, "sha2", lambda column, bits: real(F.substring(column, 1, 1), bits))
    monkeypatch.setattr(F, "xxhash64", lambda column: F.length(column).cast("long"))
    df = spark.createDataFrame([(1, "apple", "en", "a", 1), (2, "angle", "en", "a", 1), (3, "berry", "en", "a", 1), (4, "berry", "en", "a", 1)], DOCUMENTS)
    found = exact_dedup.deduplicate([df.where("doc_id in (1, 3)"), df.where("doc_id in (2, 4)")])
    assert sorted((r["id"], r["keep_id"]) for r in found.collect()) == [(1, 1), (2, 2), (3, 3), (4, 3)]


def test_empty_tables(spark, edges, none):
    assert got(exact_dedup.deduplicate([none])) == []
    assert got(exact_dedup.deduplicate([none, edges, none])) == expected(pairs(edge_rows()))


def test_given_documents(spark):
    from tonflow.llm.queries import QUERIES

    docs = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()]
    assert got(QUERIES["op11_exact_dedup"](spark, "/root/testdata/sf0.001")) == expected(docs)
