import random
import tracemalloc

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests.llm.conftest import number_words
from tonflow.llm import suffix_dedup


@settings(max_examples=200, deadline=None)
@given(st.binary(max_size=80) | st.text("ab", max_size=120).map(str.encode) | st.text("\0a", max_size=40).map(str.encode))
def test_suffix_array_and_common_prefixes(text):
    array = np.frombuffer(text, np.uint8)
    order = suffix_dedup.suffix_array(array)
    assert order.tolist() == sorted(range(len(text)), key=lambda i: text[i:])

    def common(a, b):
        return next((k for k, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), min(len(a), len(b)))

    want = [0] * bool(text) + [common(text[order[i - 1] :], text[order[i] :]) for i in range(1, len(text))]
    assert suffix_dedup.common_prefixes(array, order).tolist() == want


def brute(texts, length):
    bodies = [(t or "").encode() for t in texts]
    count = {}
    for b in bodies:
        for i in range(len(b) - length + 1):
            count[b[i : i + length]] = count.get(b[i : i + length], 0) + 1
    out = []
    for b in bodies:
        gone = bytearray(len(b))
        for i in range(len(b) - length + 1):
            if count[b[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        runs = sum(g and (i == 0 or not gone[i - 1]) for i, g in enumerate(gone))
        out.append((len(b), sum(gone), runs, bytes(x for x, g in zip(b, gone, strict=True) if not g)))
    return out


def run(df, length):
    rows = suffix_dedup.remove_repeats(df, length=length).select("doc_id", "repeats.*").collect()
    return {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in rows}


def test_memory_of_a_shard_is_bounded():
    one = np.frombuffer(number_words(0, 12_000).encode(), np.uint8)
    text = np.r_[one, one[: len(one) // 2], one[::-1]]
    tracemalloc.start()
    try:
        classes = suffix_dedup.equal_windows(text, 200)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    # 84 bytes a byte before, of shards twice as large: an executor of 3 GB was stopped.
    assert peak < 60 * len(text) and suffix_dedup.SHARD * peak < 60e6 * len(text)
    at = np.arange(len(one) // 2 - 199)
    assert (classes[at] == classes[at + len(one)]).all() and len(np.unique(classes[at])) == len(at)


@pytest.mark.parametrize("shard", [2 << 20, 600])
def test_same_as_brute_force(spark, monkeypatch, shard):
    monkeypatch.setattr(suffix_dedup, "SHARD", shard)  # small: anchors are split over shards
    rng = random.Random(11)
    passages = [number_words(100_000 + 100 * i, 40) for i in range(4)]
    common = number_words(990_000, 8)  # shorter than a window, in many texts: one anchor, many contexts
    texts = []
    for i in range(60):
        own = number_words(i * 1000, 30).split()
        for _ in range(rng.randint(0, 3)):
            at = rng.randrange(len(own))
            own[at:at] = [rng.choice([*passages, common, passages[0][: rng.randint(50, 260)]])]
        texts.append(" ".join(own))
    pair = number_words(700_000, 12) + " " + common
    texts += [f"aa {pair} bb", f"cc {pair} dd", texts[3], "ab" * 400, "z" * 350, "ü" * 120, number_words(5, 70), None, "", "short"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    want = brute(texts, 120)
    got = run(df, 120)
    assert [got[i] for i in range(len(texts))] == want


def test_long_texts_are_searched_in_overlapping_pieces(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "_PIECE", 500)
    passage = number_words(3_000_000, 60)
    texts = [number_words(0, 400) + passage + number_words(500, 100), passage + number_words(1000, 30)]
    got = run(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), 200)
    assert [got[i] for i in range(2)] == brute(texts, 200)


def test_edges(spark, edges, none):
    out = suffix_dedup.remove_repeats(edges)
    assert out.columns == [*edges.columns, "repeats"]
    rows = {}
    for r in out.collect():
        rows.setdefault(r.doc_id, []).append(r)
    assert sum(map(len, rows.values())) == 11
    assert all(r.repeats.n_removed == r.repeats.n_bytes and r["size"] == "own" for r in rows[1])
    assert rows[3][0].repeats.n_bytes == 0 and rows[6][0].repeats.n_removed == 0
    assert suffix_dedup.remove_repeats(none).count() == 0
    assert suffix_dedup.remove_repeats(edges.where(F.col("text").isNull())).count() == 1
