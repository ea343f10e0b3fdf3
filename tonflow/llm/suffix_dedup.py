"""Removal of passages that stand anywhere else, by suffix arrays.

A byte is removed if a string of ``length`` bytes that covers it also starts anywhere else,
in whichever document.  Such a string is called a window here.

Suffixes of a whole corpus are too many to sort, so windows are first dealt to shards in such
a way that equal windows meet.  Each window names an anchor: the 32 bytes in it with the
smallest hash, the leftmost of equals.  Equal windows have the same anchor, so a window whose
anchor is unique in the corpus is unique.  The neighbouring windows that share an anchor
form its context.  Contexts that are alike byte for byte are one row with a count.  What
remains, different contexts with the same anchor, goes to the shard of the anchor.

In a shard the suffixes of all contexts are sorted by Larsson and Sadakane's refinement: by
their first eight bytes, then by pairs of ranks at twice the distance, touching only groups
that are not sorted yet.  Kasai's lemma gives the common prefixes of neighbours: that of a suffix
follows from the one before it in the text, except where their preceding bytes
differ, and only there bytes are compared.  Neighbours with a common prefix of ``length`` or
more are equal windows.  An anchor with too many contexts for a shard is split over several;
each lists its classes of windows by a digest, and the sorted lists are merged by binary
search.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tonflow.llm.common import code_on_workers, pieces, stored

ANCHOR = 32
#: Bytes of contexts in a shard.
SHARD = 1 << 20
_BASES = (0x9E3779B97F4A7C15, 0xD1342543DE82EF95)
_PLACE = np.uint64((1 << 24) - 1)
#: Longer texts are searched in pieces that overlap by a window.
_PIECE = 8 << 20


def _powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base and of its inverse, modulo 2 to the 64."""
    size = 1 << max(n, 1).bit_length()
    return _kept_powers(base, size) if size <= 1 << 20 else _make_powers(base, size)


def _make_powers(base: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    out = []
    for b in (base, pow(base, -1, 1 << 64)):
        steps = np.full(size, b, np.uint64)
        steps[0] = 1
        out.append(np.multiply.accumulate(steps))
    return out[0], out[1]


_kept_powers = functools.lru_cache(maxsize=8)(_make_powers)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(32))


class _Hashes:
    """Hashes of any substrings of one array of bytes."""

    def __init__(self, text: np.ndarray, base: int = _BASES[0]):
        symbols = np.random.default_rng(base & 0xFFFF).integers(0, 2**64, 256, dtype=np.uint64)
        powers, self.back = _powers(base, len(text) + 1)
        self.sums = np.zeros(len(text) + 1, np.uint64)
        np.cumsum(symbols[text] * powers[: len(text)], out=self.sums[1:])

    def of(self, start: np.ndarray | slice, end: np.ndarray | slice) -> np.ndarray:
        return _mixed((self.sums[end] - self.sums[start]) * self.back[start])


def anchors(text: np.ndarray, ends: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """Contexts of joined texts: anchor hash, context hash, first window, number of windows.

    ``ends`` has the end of each text in ``text``; windows that cross an end don't count.
    """
    n = len(text)
    empty = np.empty(0, np.int64)
    if n < length:
        return empty.view(np.uint64), empty.view(np.uint64), empty, empty
    hashes = _Hashes(text)
    count = n - ANCHOR + 1
    grams = hashes.of(slice(0, count), slice(ANCHOR, n + 1))
    least = (grams & ~_PLACE) | np.arange(count, dtype=np.uint64)
    width, have = length - ANCHOR + 1, 1
    while have < width:
        step = min(have, width - have)
        least = np.minimum(least[:-step], least[step:])
        have += step
    place = (least & _PLACE).astype(np.int64)
    starts = np.arange(len(place))
    whole = starts + length <= ends[np.searchsorted(ends, starts, side="right")]
    starts, place = starts[whole], place[whole]
    if not len(starts):
        return empty.view(np.uint64), empty.view(np.uint64), empty, empty
    new = np.flatnonzero(np.r_[True, (np.diff(place) != 0) | (np.diff(starts) != 1)])
    first, last = starts[new], starts[np.r_[new[1:], len(starts)] - 1]
    return grams[place[new]], hashes.of(first, last + length), first, last - first + 1


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Starts of all suffixes of an array of bytes in the order of the suffixes."""
    n = len(text)
    kind = _place_kind(n)
    if n == 0:
        return np.empty(0, kind)
    key = _words(text)[:n]
    order = np.argsort(key, kind="stable").astype(kind)
    key = key[order]
    new = np.r_[True, key[1:] != key[:-1]]
    del key
    rank = np.full(n + 1, -1, kind)
    rank[order] = np.maximum.accumulate(np.arange(n, dtype=kind) * new)
    tied = _tied(new).astype(kind)
    # a key does not tell the end from zero bytes; where that matters, steps of one byte do
    h = 1 if n < 8 or (text[-8:] == 0).any() else 8
    while len(tied):
        suffix = order[tied]
        pair = rank[suffix].astype(np.int64)
        pair *= n + 1
        pair += rank[np.minimum(suffix + h, n)]
        by = np.argsort(pair, kind="stable").astype(kind)
        suffix, pair = suffix[by], pair[by]
        order[tied] = suffix
        new = np.r_[True, pair[1:] != pair[:-1]]
        del pair, by
        rank[suffix] = tied[np.maximum.accumulate(np.arange(len(tied), dtype=kind) * new)]
        tied = tied[_tied(new)]
        h *= 2
    return order


def _place_kind(n: int) -> type:
    """Four bytes a place wherever they do: the arrays of a shard are most of what a worker holds."""
    return np.int32 if n < 1 << 29 else np.int64


def _words(text: np.ndarray) -> np.ndarray:
    """The eight bytes from each place on, and from the end, as one number; zeros follow the end."""
    word = np.zeros(len(text) + 8, np.uint64)
    word[: len(text)] = text
    for step in (1, 2, 4):
        later = word[step:].copy()
        word <<= np.uint64(8 * step)
        word[:-step] |= later
    return word[: len(text) + 1]


def _tied(new: np.ndarray) -> np.ndarray:
    """Places of groups of two or more, given where groups begin."""
    return np.flatnonzero(~(new & np.r_[new[1:], True]))


def common_prefixes(text: np.ndarray, order: np.ndarray) -> np.ndarray:
    """Length of the common prefix of each suffix with the one before it in the order.

    Where the bytes before both suffixes are the same, it is one less than that of the suffix
    one byte earlier in the text (Kasai's lemma); elsewhere words of eight bytes are
    compared.
    """
    n = len(text)
    kind = _place_kind(n)
    before = np.full(n, -1, kind)
    before[order[1:]] = order[:-1]
    starts = np.arange(n, dtype=kind)
    follows = (starts > 0) & (before > 0)
    follows[follows] = text[starts[follows] - 1] == text[before[follows] - 1]
    heads = np.flatnonzero(~follows & (before >= 0)).astype(kind)
    word = _words(text)  # n + 1 words; the last is zero
    length = np.zeros(n, kind)
    a, b, at = heads.copy(), before[heads].copy(), heads
    while len(a):
        differ = word[np.minimum(a, n)] ^ word[np.minimum(b, n)]
        room = n - np.maximum(a, b)
        same, some = np.full(len(a), 8, kind), differ != 0
        same[some] = _leading_bytes(differ[some])
        same = np.minimum(same, room)
        length[at] += same
        on = same == 8
        a, b, at = a[on] + 8, b[on] + 8, at[on]
    del word, before
    chain = np.maximum.accumulate(starts * ~follows)
    length = np.where(follows, length[chain] - (starts - chain), length)
    return length[order]  # the first has none before it and keeps 0


def _leading_bytes(x: np.ndarray) -> np.ndarray:
    out = np.zeros(len(x), np.int64)
    for byte in range(1, 8):
        out += x < np.uint64(1 << (64 - 8 * byte))
    return out


def equal_windows(text: np.ndarray, length: int) -> np.ndarray:
    """A class for each place such that equal windows, and only these, have the same class."""
    order = suffix_array(text)
    classes = np.empty_like(order)
    classes[order] = np.cumsum(common_prefixes(text, order) < length, dtype=order.dtype)
    return classes


def _runs(flags: np.ndarray, owner: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of set flags within an owner: (owner, first place, last place)."""
    owner, place = owner[flags], place[flags]
    if not len(owner):
        return owner, place, place
    new = np.flatnonzero(np.r_[True, (np.diff(owner) != 0) | (np.diff(place) != 1)])
    return owner[new], place[new], place[np.r_[new[1:], len(place)] - 1]


def _tables(docs: DataFrame, text: str) -> DataFrame:
    own = F.coalesce(F.col(text), F.lit("")).cast("binary")
    return docs.withColumns({"__body": own, "__hash": F.xxhash64(own), "__bytes": F.length(own)})


def _find_anchors(docs: DataFrame, text: str, length: int) -> DataFrame:
    """(gram, context, hash, bytes, firsts, windows) of every text; alike texts of a task twice at most.

    A context that a text holds several times is one row with the list of its places, so a
    passage that is common within texts is combined before the first shuffle.
    """

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        met: dict[tuple[int, int], int] = {}
        for batch in pieces(batches, "__body", 1 << 20):
            keys = list(zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True))
            wanted = []
            for i, key in enumerate(keys):
                met[key] = met.get(key, 0) + 1
                if met[key] <= 2 and key[1] >= length:  # elsewhere means twice; more copies add nothing
                    wanted.append(i)
            if not wanted:
                continue
            bodies = batch.column(0).take(pa.array(wanted)).to_pylist()
            parts, owners, shifts = [], [], []
            for i, body in zip(wanted, bodies, strict=True):
                for at in range(0, max(1, len(body) - length + 1), _PIECE):
                    parts.append(body[at : at + _PIECE + length - 1])
                    owners.append(i)
                    shifts.append(at)
            for lo, hi in _batches([len(p) for p in parts]):
                ends = np.cumsum([len(p) for p in parts[lo:hi]])
                gram, context, first, windows = anchors(np.frombuffer(b"".join(parts[lo:hi]), np.uint8), ends, length)
                part = np.searchsorted(ends, first, side="right")
                owner = np.array(owners[lo:hi])[part]
                first = first - np.r_[0, ends][part] + np.array(shifts[lo:hi])[part]
                if not len(first):
                    continue
                by = np.lexsort((first, context, gram, owner))
                gram, context, first, windows, owner = (x[by] for x in (gram, context, first, windows, owner))
                differs = (np.diff(owner) != 0) | (gram[1:] != gram[:-1]) | (context[1:] != context[:-1])
                new = np.flatnonzero(np.r_[True, differs])
                firsts = pa.ListArray.from_arrays(
                    pa.array(np.r_[new, len(first)].astype(np.int32)), pa.array(first.astype(np.int32))
                )
                gram, context, windows, owner = gram[new], context[new], windows[new], owner[new]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(gram.view(np.int64)), pa.array(context.view(np.int64)),
                        pa.array(np.array([k[0] for k in keys], np.int64)[owner]),
                        pa.array(np.array([k[1] for k in keys], np.int32)[owner]),
                        firsts, pa.array(windows.astype(np.int32)),
                    ],
                    ["gram", "context", "hash", "bytes", "firsts", "windows"],
                )

    rows = docs.select("__body", "__hash", "__bytes")
    return rows.mapInArrow(find, "gram bigint, context bigint, hash bigint, bytes int, firsts array<int>, windows int")


def _batches(sizes: list[int]) -> Iterator[tuple[int, int]]:
    """Ranges of parts of a total of about 256 KB, which keeps the arrays in the cache."""
    lo, held = 0, 0
    for i, n in enumerate(sizes):
        if held and held + n > 1 << 18:
            yield lo, i
            lo, held = i, 0
        held += n
    if sizes:
        yield lo, len(sizes)


def _search_shard(rows: pa.Table, length: int) -> pa.Table:
    """Repeated windows of the contexts of one shard, and its classes if the anchor is split."""
    seen, keep = set(), []
    for i, key in enumerate(zip(rows["gram"].to_pylist(), rows["context"].to_pylist(), strict=True)):
        if key not in seen:  # the text of a repeated row came twice
            seen.add(key)
            keep.append(i)
    rows = rows.take(pa.array(keep))
    bodies, windows = rows["body"].to_pylist(), np.array(rows["windows"].to_pylist(), np.int64)
    times = np.minimum(np.array(rows["times"].to_pylist(), np.int64), 2)
    text = np.frombuffer(b"".join(bodies), np.uint8)
    begin = np.r_[0, np.cumsum([len(b) for b in bodies])[:-1]]
    classes = equal_windows(text, length)
    # A shard has far fewer than 2**31 bytes.
    owner = np.repeat(np.arange(len(bodies), dtype=np.int32), windows)
    place = np.arange(len(owner), dtype=np.int32) - np.repeat((np.cumsum(windows) - windows).astype(np.int32), windows)
    at = begin.astype(np.int32)[owner] + place
    classes = classes[at]
    found = np.bincount(classes, weights=times[owner], minlength=1)
    # of a context that stands twice all windows are repeated, which needs no search
    who, lo, hi = _runs((found[classes] > 1) & (times[owner] == 1), owner, place)
    grams, contexts = rows["gram"].to_numpy(), rows["context"].to_numpy()
    digest = [np.zeros(len(who), np.int64)] * 2
    parts = rows["parts"][0].as_py()
    if parts > 1:
        single, one = np.unique(classes, return_index=True)
        start = at[one]
        digest = [
            np.r_[d, _Hashes(text, b).of(start, start + length).view(np.int64)]
            for d, b in zip(digest, _BASES, strict=True)
        ]
        who, lo, hi = np.r_[who, owner[one]], np.r_[lo, place[one]], np.r_[hi, place[one]]
        weight = np.r_[np.zeros(len(digest[0]) - len(one)), np.minimum(found[single], 2)]
    else:
        weight = np.zeros(len(who))
    return pa.table(
        {
            "gram": grams[who], "context": contexts[who], "low": lo.astype(np.int32), "high": hi.astype(np.int32),
            "weight": weight.astype(np.int32), "d1": digest[0], "d2": digest[1], "parts": np.full(len(who), parts, np.int32),
        }
    )


def _merge_lists(rows: pa.Table) -> pa.Table:
    """Merge the shards' lists of some digests: windows found in two lists or more."""
    kinds = np.rec.fromarrays([rows["d1"].to_numpy(), rows["d2"].to_numpy()])
    order = np.argsort(kinds)
    by_digest = kinds[order]
    times = np.r_[0, np.cumsum(rows["weight"].to_numpy()[order])]
    low, high = (np.searchsorted(by_digest, kinds, side=s) for s in ("left", "right"))
    again = (times[high] - times[low] > 1) & (high - low > 1)
    return rows.filter(pa.array(again)).select(["gram", "context", "low", "high"])


def repeated_spans(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", length: int = 200) -> DataFrame:
    """(hash, bytes, spans) of each text with a repeated window: spans of its bytes, unmerged.

    Keyed by the text's 64-bit hash and its length in bytes.  Texts shorter than a window have
    no row; equal texts have one.  Which string stands elsewhere is judged on the input, not on
    what removal leaves.
    """
    code_on_workers(docs.sparkSession)
    bodies = _tables(docs.select(doc_id, text), text)
    found = stored(_find_anchors(bodies, text, length))
    twice = found.groupBy("gram").agg(
        F.sum(F.size("firsts")).alias("n"), F.min("context").alias("a"), F.max("context").alias("b")
    )
    # stored, so that the join below has nothing but exchanges under it and a hot anchor can be split
    twice = stored(twice.where("n > 1").select("gram", (F.col("a") != F.col("b")).alias("many")))
    repeated = stored(found.join(twice, "gram"))
    contexts = stored(
        repeated.where("many")
        .groupBy("gram", "context")
        .agg(
            F.sum(F.size("firsts")).alias("times"), F.min("windows").alias("windows"),
            F.min(F.struct("hash", "bytes", F.col("firsts")[0].alias("first"))).alias("at"),
        )
        .select("gram", "context", "times", "windows", "at.*")
    )
    sizes = stored(contexts.groupBy("gram").agg(F.sum(F.col("windows") + length).alias("size")))
    total = sizes.agg(F.sum("size")).first()[0] or 0
    shards = max(1, -(-total // SHARD))
    parts = F.ceil(F.col("size") / SHARD)
    shard = F.when(
        parts > 1, F.xxhash64("gram", F.pmod("context", parts))
    ).otherwise(F.pmod(F.xxhash64("gram"), F.lit(shards)))
    asked = contexts.join(sizes, "gram").select(
        "hash", "bytes",
        F.struct(
            shard.alias("shard"), parts.cast("int").alias("parts"), "gram", "context",
            F.least("times", F.lit(2)).cast("int").alias("times"), "windows", "first",
        ).alias("ask"),
    )
    asked = asked.groupBy("hash", "bytes").agg(F.collect_list("ask").alias("asks"))
    one = bodies.groupBy(F.col("__hash").alias("hash"), F.col("__bytes").alias("bytes")).agg(F.min(doc_id).alias("one"))
    asked = asked.join(one, ["hash", "bytes"]).alias("a")
    given = (
        bodies.alias("b")
        .join(
            asked,
            (F.col("b.__hash") == F.col("a.hash"))
            & (F.col("b.__bytes") == F.col("a.bytes"))
            & F.col(f"b.{doc_id}").eqNullSafe(F.col("a.one")),
        )
        .select("__body", F.explode("asks").alias("ask"))
        .select("ask.*", F.substring("__body", F.col("ask.first") + 1, F.col("ask.windows") + length - 1).alias("body"))
    )
    schema = "gram bigint, context bigint, low int, high int, weight int, d1 bigint, d2 bigint, parts int"
    searched = stored(given.groupBy("shard").applyInArrow(lambda t: _search_shard(t, length), schema))
    lists = searched.where("weight > 0").withColumn("range", F.pmod("d1", F.col("parts") * 256))
    merged = lists.groupBy("gram", "range").applyInArrow(_merge_lists, "gram bigint, context bigint, low int, high int")
    runs = searched.where("weight = 0").select("gram", "context", "low", "high").unionByName(merged)
    every = contexts.where("times > 1").select("gram", "context", F.lit(0).alias("low"), (F.col("windows") - 1).alias("high"))
    # one row per context, so that the join below gives one row per context of a text
    runs = runs.unionByName(every).groupBy("gram", "context").agg(F.collect_set(F.struct("low", "high")).alias("runs"))

    def span(first, low, high):
        return F.struct((first + low).cast("int").alias("low"), (first + high + length).cast("int").alias("high"))

    whole = F.transform("firsts", lambda f: span(f, F.lit(0), F.col("windows") - 1))
    same = repeated.where(~F.col("many")).select("hash", "bytes", whole.alias("spans"))
    some = F.flatten(F.transform("firsts", lambda f: F.transform("runs", lambda r: span(f, r["low"], r["high"]))))
    differing = repeated.where("many").join(runs, ["gram", "context"]).select("hash", "bytes", some.alias("spans"))
    return same.unionByName(differing).groupBy("hash", "bytes").agg(F.flatten(F.collect_list("spans")).alias("spans"))


def remove_repeats(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", length: int = 200, decoded: bool = True
) -> DataFrame:
    """Add ``repeats``, a struct: kept (binary), text, n_bytes, n_removed, n_spans.

    ``kept`` are the UTF-8 bytes that remain, joined; a cut may go through a character, of
    which ``text``, the same as text, drops what is left (null unless ``decoded``).  A
    null text counts as empty and stays nothing; a repeated row's text, if it has ``length``
    bytes, is removed from all of its rows.  All columns stay, whatever their names; an empty
    table gives no rows.
    """
    spans = repeated_spans(docs, doc_id, text, length)
    rows = _tables(docs.select(F.struct("*").alias("__row"), F.col(text).alias("__text")), "__text").drop("__text")
    joined = rows.join(
        spans, (F.col("__hash") == F.col("hash")) & (F.col("__bytes") == F.col("bytes")), "left"
    )
    def cut(bodies: pa.Array, spans: pa.Array) -> pa.Array:
        return _cut(bodies, spans, decoded)

    result = F.arrow_udf(cut, "kept binary, text string, n_removed bigint, n_spans bigint")("__body", "spans")
    return joined.select("__row.*", result.alias("__cut"), F.col("__bytes").cast("long").alias("__n")).select(
        *[f"`{c}`" for c in docs.columns if c != "repeats"],
        F.struct("__cut.kept", "__cut.text", F.col("__n").alias("n_bytes"), "__cut.n_removed", "__cut.n_spans").alias("repeats"),
    )


#: Bodies that are held as Python objects at once.
_CUT_ROWS = 256


def _cut(bodies: pa.Array, spans: pa.Array, decoded: bool) -> pa.Array:
    """What remains of each body without its spans (as text, too, if asked for), bytes removed and removed runs."""
    done = [_cut_some(bodies.slice(at, _CUT_ROWS), spans.slice(at, _CUT_ROWS), decoded) for at in range(0, max(len(bodies), 1), _CUT_ROWS)]
    return pa.concat_arrays(done)


def _cut_some(bodies: pa.Array, spans: pa.Array, decoded: bool) -> pa.Array:
    kept, removed, runs = [], [], []
    for body, own in zip(bodies.to_pylist(), spans.to_pylist(), strict=True):
        left, at, gone, n = [], 0, 0, 0
        for low, high in sorted((s["low"], s["high"]) for s in own or ()):
            if low > at or n == 0:
                left.append(body[at:low])
                at, n = low, n + 1
            gone += max(0, high - at)
            at = max(at, high)
        kept.append(b"".join([*left, body[at:]]))
        removed.append(gone)
        runs.append(n)
    whole = pa.array(kept, pa.binary())
    text = pa.array([x.decode("utf-8", "ignore") for x in kept], pa.string()) if decoded else pa.nulls(len(kept), pa.string())
    return pa.StructArray.from_arrays(
        [whole, text, pa.array(removed, pa.int64()), pa.array(runs, pa.int64())], ["kept", "text", "n_removed", "n_spans"]
    )
