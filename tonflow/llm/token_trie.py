"""Token counts by dynamic programming that words share through a trie.

The text is cut into pre-tokens.  A pre-token's best segmentation under a unigram model of
the vocabulary is found by forward scores: the best score of its first n bytes.  These
depend on the first n bytes only, so distinct pre-tokens are put into a trie and each
node's forward score is computed once for all pre-tokens that share the prefix; the number
of tokens is kept where a pre-token ends.
"""

from __future__ import annotations

import base64
import functools
import math
from collections.abc import Iterator

import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tonflow.llm.common import code_on_workers, pieces

VOCABULARY = "byte_bpe_50k.tiktoken"


def unigram_scores(ranks: dict[bytes, int]) -> dict[bytes, float]:
    """Log probabilities by Zipf's law: merged tokens in the order of their rank, bytes last."""
    order = sorted(ranks, key=lambda t: (len(t) == 1, ranks[t]))
    total = math.log(sum(1 / (i + 1) for i in range(len(order))))
    return {t: -math.log(i + 1) - total for i, t in enumerate(order)}


class TokenTrie(dict):
    """Token counts by pre-token (a dict that fills itself); ``nodes`` bounds its memory.

    Of equally good segmentations the one with fewer tokens counts.  A full trie is begun
    anew; the counts at its ends are kept in two generations of half as many pre-tokens each, so
    that frequent ones are not walked again.
    """

    def __init__(self, scores: dict[bytes, float], nodes: int = 400_000, letters: int = 64):
        super().__init__()
        self.scores, self.nodes, self.most, self.letters = scores, nodes, nodes // 2, letters
        self.longest = max(map(len, scores))
        self.computed = 0
        self.old: dict[str, int] = {}
        self._empty()

    def _empty(self) -> None:
        self.children: dict[int, int] = {}
        self.best: list[tuple[float, int]] = [(0.0, 0)]  # score and minus the number of tokens

    def __missing__(self, word: str) -> int:
        count = self.old.get(word)
        if count is None:
            count = self._walk(word.encode())
        if len(word) <= self.letters:
            if len(self) >= self.most:
                self.old = dict(self)
                self.clear()
            self[word] = count
        return count

    def _walk(self, text: bytes) -> int:
        if len(self.best) + len(text) > self.nodes:
            self._empty()
        path, children, best, scores = [0], self.children, self.best, self.scores
        for n in range(1, len(text) + 1):
            step = path[-1] << 8 | text[n - 1]
            node = children.get(step)
            if node is None:
                node = children[step] = len(best)
                self.computed += 1
                found = (-math.inf, 0)
                for at in range(max(0, n - self.longest), n):
                    score = scores.get(text[at:n])
                    if score is not None:
                        before, count = best[path[at]]
                        found = max(found, (before + score, count - 1))
                best.append(found)
            path.append(node)
        return -best[path[-1]][1]


@functools.lru_cache(maxsize=2)
def _trie(path: str, pattern: str) -> tuple[TokenTrie, regex.Pattern]:
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(token): int(i) for token, i in map(bytes.split, lines)}
    return TokenTrie(unigram_scores(ranks)), regex.compile(pattern)


def count_tokens(
    docs: DataFrame,
    carry: tuple[str, ...] = ("doc_id",),
    text: str = "text",
    vocabulary: str = VOCABULARY,
    pattern: str = public_tokenizers.PATTERN,
) -> DataFrame:
    """Tokens of every whole text under the unigram model of a public vocabulary.

    Returns the columns of ``carry``, ``n_tokens`` and ``n_pretokens`` (long).  A null or
    empty text has none of either; repeated rows are counted each for itself; further
    columns are left out.  Each worker keeps a trie of what it has seen, up to a fixed number
    of nodes, and begins a new one beyond; the counts do not depend on that.
    """
    code_on_workers(docs.sparkSession)
    schema = ", ".join(
        [f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in carry] + ["n_tokens bigint", "n_pretokens bigint"]
    )

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie, cut = _trie(public_tokenizers.path(vocabulary), pattern)
        for batch in pieces(batches, "__text"):
            words = [cut.findall(x) for x in batch.column(len(carry)).to_pylist()]
            columns = [batch.column(i) for i in range(len(carry))]
            columns.append(pa.array([sum(map(trie.__getitem__, x)) for x in words], pa.int64()))
            columns.append(pa.array([len(x) for x in words], pa.int64()))
            yield pa.RecordBatch.from_arrays(columns, [*carry, "n_tokens", "n_pretokens"])

    own_text = F.coalesce(F.col(text), F.lit("")).alias("__text")
    return docs.select(*carry, own_text).mapInArrow(count, schema)
