"""Byte-level BPE and token counts."""

import base64
import math
import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import regex
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from tests.llm.conftest import edge_rows
from tonflow.llm import byte_pairs, token_trie


def ranks():
    with open(public_tokenizers.path(byte_pairs.VOCABULARY), "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


RANKS = ranks()
TRUTH = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=RANKS, special_tokens={})
CODER = byte_pairs.coder(public_tokenizers.path(byte_pairs.VOCABULARY), public_tokenizers.PATTERN)


def ids(text):
    return np.frombuffer(CODER.encode(text), "<u4").tolist()


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=60) | st.text("abehint ", max_size=200) | st.sampled_from(["<|endoftext|>", "\r\n \n", "a" * 5000]))
def test_ids_are_those_of_tiktoken(text):
    assert ids(text) == TRUTH.encode_ordinary(text)
    assert CODER.decode(CODER.encode(text)) == text.encode()


def test_every_token_is_itself():
    for token in random.Random(1).sample(sorted(RANKS), 3000):
        assert CODER.encode_piece(token) == [RANKS[token]]


def test_texts_with_edges(edges, none):
    rows = byte_pairs.encode_texts(edges, carry=("doc_id", "text"), decoded=True).collect()
    assert len(rows) == len(edge_rows())
    for r in rows:
        text = r.text or ""
        assert np.frombuffer(bytes(r.token_ids), "<u4").tolist() == TRUTH.encode_ordinary(text)
        assert bytes(r.decoded) == text.encode() and r.n_tokens == len(r.token_ids) // 4
    tokens = byte_pairs.encode_texts(edges)
    assert byte_pairs.decode_ids(tokens).count() == len(rows)
    assert byte_pairs.encode_texts(none).count() == 0


def test_workers_keep_no_texts(spark, edges):
    def held(batches):
        own = byte_pairs.coder(public_tokenizers.path(byte_pairs.VOCABULARY), public_tokenizers.PATTERN)
        for batch in batches:
            n = len(own.cache) + len(own.cache.old) + len(own.follows)
            yield pa.RecordBatch.from_arrays([pa.array([n] * batch.num_rows, pa.int64())], ["n"])

    byte_pairs.encode_texts(edges.repartition(4)).collect()
    # Workers are used again; what a finished task had remembered stayed with them before.
    assert spark.range(0, 16, 1, 4).mapInArrow(held, "n long").agg({"n": "max"}).first()[0] == 0


def best_count(piece, scores):
    best = [(0.0, 0)] + [(-math.inf, 0)] * len(piece)
    for n in range(1, len(piece) + 1):
        for at in range(n):
            if piece[at:n] in scores:
                best[n] = max(best[n], (best[at][0] + scores[piece[at:n]], best[at][1] - 1))
    return -best[-1][1]


def test_counts_against_plain_programming(edges, none):
    scores = token_trie.unigram_scores(RANKS)
    assert sum(map(math.exp, scores.values())) == pytest.approx(1)
    cut = regex.compile(public_tokenizers.PATTERN)
    rows = token_trie.count_tokens(edges.where("doc_id is null or doc_id <> 6"), carry=("text",)).collect()
    for r in rows:
        found = cut.findall(r.text or "")
        assert r.n_pretokens == len(found)
        assert r.n_tokens == sum(best_count(p.encode(), scores) for p in found)
    assert token_trie.count_tokens(none).count() == 0


def test_prefixes_are_computed_once_and_memory_is_bounded():
    scores = token_trie.unigram_scores(RANKS)
    trie = token_trie.TokenTrie(scores)
    trie["straw"], trie["strawberry"], trie["straws"]
    assert trie.computed == len("strawberry") + 1
    small = token_trie.TokenTrie(scores, nodes=50)
    words = [f"word{i}" for i in range(100)] + ["x" * 500]
    assert [small[w] for w in words] == [trie[w] for w in words]
    assert len(small) < 60
