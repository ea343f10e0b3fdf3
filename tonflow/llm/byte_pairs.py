"""Byte-level BPE encoding and decoding with the ranks of a public vocabulary.

The text is cut by the vocabulary's own pattern; each piece is encoded alone.  Bytes are
mapped to Latin-1 characters, so that an automaton of pyahocorasick finds the longest token
at a place.  A piece is covered from the left by longest matches; a token may follow
another only if the merges would have kept the border between the two.  Where no token may
follow, the place is marked as dead and the last token gives way to its next shorter prefix.
Every place dies at most once, so the work is linear in the piece, and the tokens are those
that merging by rank gives.
"""

from __future__ import annotations

import base64
import functools
import struct
from collections.abc import Iterator

import ahocorasick
import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tonflow.llm.common import code_on_workers, pieces

VOCABULARY = "byte_bpe_50k.tiktoken"
_NEVER = 1 << 60
#: Tokens decoded at once.
_TOKENS = 1 << 16


class _Cache(dict):
    """Packed ids by piece, in two generations of ``most`` pieces each.

    A full generation becomes the old one, and the one before it is forgotten; what is met again
    in the old one moves on, so frequent pieces stay.  Long pieces are computed anew.
    """

    def __init__(self, coder: BytePairs, most: int = 200_000, longest: int = 64):
        super().__init__()
        self.coder, self.most, self.longest = coder, most, longest
        self.old: dict[str, bytes] = {}

    def __missing__(self, piece: str) -> bytes:
        packed = self.old.get(piece)
        if packed is None:
            ids = self.coder.encode_piece(piece.encode())
            packed = struct.pack(f"<{len(ids)}I", *ids)
        if len(piece) <= self.longest:
            if len(self) >= self.most:
                self.old = dict(self)
                self.clear()
            self[piece] = packed
        return packed


class BytePairs:
    """Encoder and decoder for one table of ranks (bytes of a token to its id)."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks = ranks
        self.bytes_of = [b""] * (max(ranks.values()) + 1)
        for token, i in ranks.items():
            self.bytes_of[i] = token
        self.all_bytes = np.frombuffer(b"".join(self.bytes_of), np.uint8)
        self.lengths = np.array([len(x) for x in self.bytes_of], np.int64)
        self.begins = np.cumsum(self.lengths) - self.lengths
        self.halves: dict[int, tuple[int, int]] = {}
        self.joined: dict[tuple[int, int], int] = {}
        self.follows: dict[tuple[int, int], bool] = {}
        self.shorter: dict[int, int] = {}
        self.automaton = ahocorasick.Automaton()
        for i in sorted(ranks.values()):
            token = self.bytes_of[i]
            if len(token) > 1 and not self._take_apart(i, token):
                continue  # no sequence of merges makes it
            self.automaton.add_word(token.decode("latin-1"), i)
        self.automaton.make_automaton()
        for i in (i for i, token in enumerate(self.bytes_of) if token):
            self.shorter[i] = self._longest_prefix(self.bytes_of[i])
        self.cut = regex.compile(pattern)
        self.cache = _Cache(self)

    def _take_apart(self, i: int, token: bytes) -> bool:
        """Find the two tokens whose merge has rank ``i``."""
        for at in range(1, len(token)):
            left, right = self.ranks.get(token[:at], _NEVER), self.ranks.get(token[at:], _NEVER)
            made = all(x < i and (x in self.halves or len(self.bytes_of[x]) == 1) for x in (left, right))
            if made and self._border_holds(left, right):
                self.halves[i] = (left, right)
                self.joined[left, right] = i
                return True
        return False

    def _longest_prefix(self, token: bytes) -> int:
        for n in range(len(token) - 1, 0, -1):
            i = self.ranks.get(token[:n])
            if i is not None and (n == 1 or i in self.halves):
                return i
        return -1

    def _border_holds(self, left: int, right: int) -> bool:
        """Would merging by rank leave a border between these two neighbours?

        Merges are undone from the latest to the earliest on both sides of the border.  At
        each moment the two tokens that touch it must not have been due to merge before
        either of them was merged into something else.  Of equal merges the left is first.
        """
        left_until = right_until = _NEVER
        while True:
            merge = self.joined.get((left, right), _NEVER)
            if merge < left_until and merge <= right_until:
                return False
            left_made, right_made = left in self.halves, right in self.halves
            if left_made and (not right_made or left > right):
                left_until, left = left, self.halves[left][1]
            elif right_made:
                right_until, right = right, self.halves[right][0]
            else:
                return True

    def may_follow(self, left: int, right: int) -> bool:
        known = self.follows.get((left, right))
        if known is None:
            if len(self.follows) >= 100_000:
                self.follows.clear()
            known = self.follows[left, right] = self._border_holds(left, right)
        return known

    def encode_piece(self, piece: bytes) -> list[int]:
        whole = self.ranks.get(piece)
        if whole is not None:
            return [whole]
        text, end = piece.decode("latin-1"), len(piece)
        dead, tokens, at = bytearray(end + 1), [], 0

        def longest() -> int:
            return next(self.automaton.iter_long(text, at))[1]

        token = longest() if end else -1
        while at < end:
            while token >= 0:
                to = at + len(self.bytes_of[token])
                if not dead[to] and (not tokens or self.may_follow(tokens[-1], token)):
                    break
                token = self.shorter[token]
            if token >= 0:
                tokens.append(token)
                at = to
                token = longest() if at < end else -1
            else:
                dead[at] = 1
                last = tokens.pop()
                at -= len(self.bytes_of[last])
                token = self.shorter[last]
        return tokens

    def forget(self) -> None:
        """Free what has been remembered of texts, some 50 MB; it is found again when needed."""
        self.cache.clear()
        self.cache.old = {}
        self.follows.clear()

    def encode(self, text: str) -> bytes:
        """Ids of a text as little-endian unsigned 32-bit integers."""
        return b"".join(map(self.cache.__getitem__, self.cut.findall(text)))

    def decode(self, packed: bytes) -> bytes:
        """The bytes of all tokens, a block of tokens at a time."""
        ids, out = np.frombuffer(packed, dtype="<u4"), []
        for at in range(0, len(ids), _TOKENS):
            some = ids[at : at + _TOKENS]
            lengths = self.lengths[some]
            # the n-th byte of the output lies so far behind or before the n-th byte of the table
            shift = self.begins[some] - (np.cumsum(lengths) - lengths)
            out.append(self.all_bytes[np.repeat(shift, lengths) + np.arange(lengths.sum())].tobytes())
        return b"".join(out)


@functools.lru_cache(maxsize=2)
def coder(path: str, pattern: str) -> BytePairs:
    """One encoder per worker process and vocabulary."""
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(token): int(i) for token, i in map(bytes.split, lines)}
    return BytePairs(ranks, pattern)


def encode_texts(
    docs: DataFrame,
    carry: tuple[str, ...] = ("doc_id",),
    text: str = "text",
    vocabulary: str = VOCABULARY,
    pattern: str = public_tokenizers.PATTERN,
    decoded: bool = False,
) -> DataFrame:
    """Token ids of every whole text; special tokens are ordinary text.

    Returns the columns named in ``carry`` (cast to nothing else), ``n_tokens`` long,
    ``token_ids`` binary (little-endian unsigned 32-bit) and, if asked for, ``decoded``
    binary: the bytes those ids stand for.  A null or empty text has no tokens.  Repeated
    rows are encoded each for itself; further columns are left out.  The vocabulary is a
    file that every worker's ``public_tokenizers`` has.
    """
    code_on_workers(docs.sparkSession)
    schema = ", ".join(
        [f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in carry]
        + ["n_tokens bigint", "token_ids binary"]
        + ["decoded binary"] * decoded
    )

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = coder(public_tokenizers.path(vocabulary), pattern)
        try:
            for batch in pieces(batches, "__text"):
                packed = [own.encode(x) for x in batch.column(len(carry)).to_pylist()]
                columns = [batch.column(i) for i in range(len(carry))]
                columns += [pa.array([len(x) // 4 for x in packed], pa.int64()), pa.array(packed, pa.binary())]
                names = [*carry, "n_tokens", "token_ids"]
                if decoded:
                    columns.append(pa.array([own.decode(x) for x in packed], pa.binary()))
                    names.append("decoded")
                yield pa.RecordBatch.from_arrays(columns, names)
        finally:
            own.forget()  # Spark keeps the worker for later tasks, also those of other stages

    own_text = F.coalesce(F.col(text), F.lit("")).alias("__text")
    return docs.select(*carry, own_text).mapInArrow(encode, schema)


def decode_ids(
    tokens: DataFrame,
    carry: tuple[str, ...] = ("doc_id",),
    ids: str = "token_ids",
    vocabulary: str = VOCABULARY,
    pattern: str = public_tokenizers.PATTERN,
) -> DataFrame:
    """The bytes that packed ids stand for, as column ``decoded``; null ids give no bytes."""
    code_on_workers(tokens.sparkSession)
    schema = ", ".join([f"`{c}` {tokens.schema[c].dataType.simpleString()}" for c in carry] + ["decoded binary"])

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = coder(public_tokenizers.path(vocabulary), pattern)
        for batch in pieces(batches, "__ids"):
            out = [own.decode(x or b"") for x in batch.column(len(carry)).to_pylist()]
            columns = [batch.column(i) for i in range(len(carry))] + [pa.array(out, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, [*carry, "decoded"])

    return tokens.select(*carry, F.col(ids).alias("__ids")).mapInArrow(decode, schema)
