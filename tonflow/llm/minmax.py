"""Near-duplicate detection by min-max hashing.

Of every permutation of a document's shingles both the minimum and the maximum are kept, which
gives two signature values for one evaluation.  Bands of four values, all from different
permutations, put documents into buckets; 20 bands miss a pair at a similarity of 0.85 with a
probability of 4e-7.  Documents with the same set of shingles are one class and are compared
once.

A bucket has a hub: the member that meets most others in all its buckets, which among copies
of one text is the text they were made from.  Buckets with one hub form a group, which is
compared on full sets in parts of at most ``PER_TASK`` members, each with a copy of the hub:
all members with the hub, then, block-wise within the part, those that are not in one
component yet.  Only links that join components leave the task.

In a group of several parts, similar members of different parts remain.  They can only be
similar if their differences from the hub share an element early in a fixed order (elements
that the hub lacks come first): the prefix filter, applied to differences.  So the members of a
second and last round meet by these elements: all that share one, unless they are in one
component already, are compared with each other, in pairs of blocks where they are more than a
task takes.  No similar pair that met in a bucket is missed, and two rounds do for any group.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tonflow.llm.common import code_on_workers, pieces
from tonflow.sources.session import Scratch

BANDS, PER_BAND = 20, 4
PERMUTATIONS = BANDS * PER_BAND // 2
_ODD = np.uint64(0x9E3779B97F4A7C15)
#: Members of a group, and shingles of all of them, that are compared with each other at once.
PER_TASK, SHINGLES_PER_TASK = 2_000, 2_000_000


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(29))


def _parameters() -> tuple[np.ndarray, np.ndarray]:
    random = np.random.default_rng(20)
    a, b = random.integers(0, 2**64, (2, PERMUTATIONS), dtype=np.uint64)
    return a | np.uint64(1), b


class _Words(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= 100_000:
            self.clear()
        h = xxhash.xxh3_64_intdigest(word)
        if len(word) <= 64:
            self[word] = h
        return h


def shingles(text: bytes | None, words: _Words, width: int = 5) -> np.ndarray:
    """The set of a text's shingles as sorted 64-bit hashes.

    A-Z are lower-cased; words are what white space (tab to carriage return, space) leaves.
    A text of fewer words has its whole sequence as its only shingle; without words none.
    """
    found = (text or b"").lower().split()
    if not found:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(words.__getitem__, found), np.uint64, len(found))
    n = min(width, len(found))
    count = len(found) - n + 1
    out = np.full(count, n, np.uint64)
    for i in range(n):
        out = out * _ODD + h[i : i + count]
    return np.unique(_mixed(out))


def signed(docs: DataFrame, doc_id: str, text: str, width: int = 5) -> DataFrame:
    """A row per document: id, md5 of the text, class (digest of the set), size, band hashes."""
    code_on_workers(docs.sparkSession)
    a, b = _parameters()
    kind = docs.schema[doc_id].dataType.simpleString()

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _Words()
        for batch in pieces(batches, "text", 1 << 20):
            sets = [shingles(x, words, width) for x in batch.column(2).to_pylist()]
            sizes = np.array([len(s) for s in sets], np.int64)
            bands = np.zeros((len(sets), BANDS), np.uint64)
            full = np.flatnonzero(sizes)
            if len(full):
                whole = np.concatenate([sets[i] for i in full])
                starts = np.concatenate([[0], np.cumsum(sizes[full])[:-1]])
                half = BANDS // 2
                for k in range(PERMUTATIONS):
                    moved = whole * a[k] + b[k]
                    band = k // PER_BAND
                    for at, pick in ((band, np.minimum), (band + half, np.maximum)):
                        bands[full, at] = _mixed(bands[full, at] * _ODD + pick.reduceat(moved, starts))
                bands[full] = _mixed(bands[full] + np.arange(1, BANDS + 1, dtype=np.uint64))
            digests = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets]
            lists = pa.ListArray.from_arrays(
                pa.array(np.arange(len(sets) + 1) * BANDS, pa.int32()), pa.array(bands.view(np.int64).ravel(), pa.int64())
            )
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(digests, pa.binary()), pa.array(sizes, pa.int64()), lists],
                ["id", "key", "class", "size", "bands"],
            )

    rows = docs.select(
        F.col(doc_id).alias("id"), F.md5(F.coalesce(F.col(text), F.lit(""))).alias("key"), F.col(text).cast("binary").alias("text")
    )
    return rows.mapInArrow(sign, f"id {kind}, key string, class binary, size bigint, bands array<bigint>")


def prefix_length(d: int, n: int, m: int, percent: int) -> int:
    """How many elements of a difference a similar set's difference must share one of.

    ``d`` elements make the difference of a set of ``n`` from a hub of ``m``.  With the
    similarity p, two sets are similar if their difference has at most (1-p)/(1+p) times
    both their sizes; call this their slack.  From that follows how many elements the
    differences of two similar sets from a third have in common, at least:
    (d1 + d2 - slack) / 2.  A set similar to the hub needs only be found by ones that are
    not, whose d2 is above their own slack with the hub; one that is not similar may be
    found by any whose d2 is at least d1 - slack.  All in whole numbers.
    """
    more, less = 100 + percent, 100 - percent
    if more * d <= less * (n + m):
        common = (more * d - less * (n - m)) // (2 * more) + 1
    else:  # the partner has at most n / p shingles
        common = d - (less * (n + n * 100 // percent)) // more
    return d - max(1, min(common, d)) + 1


def difference_prefix(own: np.ndarray, hub: np.ndarray, percent: int) -> np.ndarray:
    """The prefix of a difference in an order that needs no counts: what the hub lacks first."""
    added = own[~np.isin(own, hub, assume_unique=True)]
    lacking = hub[~np.isin(hub, own, assume_unique=True)]
    keep = prefix_length(len(added) + len(lacking), len(own), len(hub), percent)
    return np.concatenate([added, lacking])[:keep]


def spanning_links(sets: list[np.ndarray], percent: int, labels: list | None = None) -> list[tuple[int, int]]:
    """Links between sets that are similar, as few as join what is similar; set 0 is the hub.

    After the hub, a set is compared with those of other components that share an element of
    its difference's prefix, elements that few differences have coming first.  Sets with the same
    one of ``labels`` (None: unknown) are in one component from the beginning.
    """
    first: dict = {}
    top = [i if label is None else first.setdefault(label, i) for i, label in enumerate(labels or [None] * len(sets))]

    def root(x: int) -> int:
        while top[x] != x:
            top[x] = x = top[top[x]]
        return x

    def similar(i: int, j: int) -> bool:
        both = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
        return 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both)

    links = []
    for i in range(1, len(sets)):
        if root(i) != root(0) and similar(i, 0):
            x, y = sorted((root(i), root(0)))
            top[y] = x
            links.append((i, 0))
    if len(sets) == 2 or all(root(i) == root(0) for i in range(1, len(sets))):
        return links
    differences = [np.setxor1d(s, sets[0], assume_unique=True) for s in sets]
    ends = np.cumsum([len(d) for d in differences])
    _, element, times = np.unique(np.concatenate(differences), return_inverse=True, return_counts=True)
    rank = np.empty(len(times), np.int64)
    rank[np.argsort(times, kind="stable")] = np.arange(len(times))
    alone = int((times == 1).sum())  # lower ranks are in one difference only
    seen: dict[int, list[int]] = {}
    for i in range(1, len(sets)):
        own = np.sort(rank[element[ends[i - 1] : ends[i]]])
        own = own[: prefix_length(len(own), len(sets[i]), len(sets[0]), percent)]
        tried: set[int] = set()
        for r in own[np.searchsorted(own, alone) :].tolist():
            others = seen.setdefault(r, [])
            for j in others:
                if j not in tried and root(j) != root(i):
                    tried.add(j)
                    if similar(i, j):
                        x, y = sorted((root(i), root(j)))
                        top[y] = x
                        links.append((i, j))
            others.append(i)
    return links


def fetched(docs: DataFrame, classes: DataFrame, wanted: DataFrame, doc_id: str, text: str) -> DataFrame:
    """(class, text): one text of each wanted class, found by the id and the hash of one of its documents."""
    texts = docs.select(
        F.col(doc_id).alias("id"), F.md5(F.coalesce(F.col(text), F.lit(""))).alias("key"), F.col(text).cast("binary").alias("text")
    )
    asked = wanted.distinct().join(classes.select("class", "id", "key"), "class")
    met = texts.alias("t").join(asked.alias("a"), (F.col("t.key") == F.col("a.key")) & F.col("t.id").eqNullSafe(F.col("a.id")))
    # Rows alike in id and text meet here, before they are shuffled again.
    return met.groupBy("class").agg(F.first("text").alias("text"))


def compared(texts: DataFrame, tasks: DataFrame, percent: int) -> DataFrame:
    """Compare tasks (grp, part, split, rank, class, label) on full sets; rank 0 is the hub.

    Gives rows of two kinds: links (a, b), and, of groups that are ``split`` into parts, members ``a``
    with the ``prefix`` of their difference from the hub.
    """
    code_on_workers(texts.sparkSession)
    met = (
        tasks.join(texts, "class")
        .select("grp", "part", "split", "rank", "class", "label", "text")
        .repartition("grp", "part")
        .sortWithinPartitions("grp", "part", "rank", "class")
    )

    def solved(grp: int, split: bool, names: list[bytes], sets: list[np.ndarray], labels: list) -> pa.RecordBatch:
        links = spanning_links(sets, percent, labels)
        a, b, prefix = [names[i] for i, _ in links], [names[j] for _, j in links], [None] * len(links)
        if split:
            a += names[1:]
            b += [None] * (len(names) - 1)
            prefix += [difference_prefix(s, sets[0], percent).view(np.int64) for s in sets[1:]]
        return pa.RecordBatch.from_arrays(
            [pa.array([grp] * len(a), pa.int64()), pa.array(a, pa.binary()), pa.array(b, pa.binary()),
             pa.array(prefix, pa.list_(pa.int64()))],
            ["grp", "a", "b", "prefix"],
        )

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, at, names, sets, labels = _Words(), None, [], [], []
        for batch in pieces(batches, "text", 1 << 20):
            for grp, part, split, _, name, label, body in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if at != (grp, part, split):
                    if sets:
                        yield solved(at[0], at[2], names, sets, labels)
                    at, names, sets, labels = (grp, part, split), [], [], []
                if not names or name not in (names[0], names[-1]):
                    names.append(name)
                    sets.append(shingles(body, words))
                    labels.append(label)
        if sets:
            yield solved(at[0], at[2], names, sets, labels)

    return met.mapInArrow(compare, "grp bigint, a binary, b binary, prefix array<bigint>")


def _load() -> Column:
    return F.ceil(F.greatest(F.count("*") / PER_TASK, F.sum("size") / SHINGLES_PER_TASK))


_TASK = ("grp", "part", "split", "rank", "class", "label")


def _first_tasks(groups: DataFrame, classes: DataFrame) -> DataFrame:
    """Groups (grp, hub, member) in parts, each with the hub."""
    sized = groups.join(classes.select(F.col("class").alias("member"), "size"), "member")
    parts = sized.groupBy("grp", "hub").agg(_load().cast("long").alias("parts")).withColumn("split", F.col("parts") > 1)
    unknown = F.lit(None).cast("binary").alias("label")
    members = groups.join(parts.select("grp", "parts", "split"), "grp").select(
        "grp", F.pmod(F.xxhash64("member"), F.col("parts")).alias("part"), "split", F.lit(1).alias("rank"),
        F.col("member").alias("class"), unknown,
    )
    hubs = parts.select(
        "grp", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("part"), "split", F.lit(0).alias("rank"),
        F.col("hub").alias("class"), unknown,
    )
    return members.unionByName(hubs).select(*_TASK)


def _last_tasks(open_: DataFrame, hubs: DataFrame, classes: DataFrame, labels: DataFrame, scratch: Scratch) -> DataFrame:
    """Members (grp, a, prefix) of split groups that share an element and are not in one component.

    Elements with the same members count once.  More members than a task takes are dealt to blocks of half
    a task, and each pair of blocks is a task.
    """
    named = open_.join(labels, open_["a"] == labels["node"], "left").select(
        "grp", F.col("a").alias("member"), F.coalesce("label", "a").alias("label"), "prefix"
    )
    spans = named.groupBy("grp").agg(F.min("label").alias("low"), F.max("label").alias("high")).where("low <> high")
    shared = scratch.keep(
        named.join(spans.select("grp"), "grp")
        .select("grp", "member", "label", F.explode("prefix").alias("element"))
        .select(F.col("grp").alias("parent"), F.xxhash64("grp", "element").alias("bucket"), "member", "label")
    )
    buckets = (
        shared.join(classes.select(F.col("class").alias("member"), "size"), "member")
        .groupBy("parent", "bucket")
        .agg(
            F.min("label").alias("low"), F.max("label").alias("high"), _load().alias("load"),
            F.count("*").alias("n"), F.bit_xor(F.xxhash64("member")).alias("who"),
        )
        .where("low <> high")
        .groupBy("parent", "n", "who")
        .agg(F.min("bucket").alias("bucket"), F.max("load").alias("load"))
        .withColumn("blocks", F.when(F.col("load") > 1, 2 * F.col("load")).otherwise(F.lit(1)).cast("long"))
    )
    buckets = scratch.keep(buckets.select("parent", "bucket", "blocks"))
    met = shared.join(buckets.drop("parent"), "bucket")
    block = F.pmod(F.xxhash64("member"), F.col("blocks"))
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))
    met = met.select("bucket", "blocks", "member", "label", block.alias("own"), other.alias("other"))
    low, high = F.least("own", "other"), F.greatest("own", "other")
    members = met.select(
        F.col("bucket").alias("grp"), (low * F.col("blocks") + high).alias("part"), F.lit(False).alias("split"), F.lit(1).alias("rank"),
        F.col("member").alias("class"), "label",
    )
    # Every task needs its group's hub, from which differences are taken.
    i = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))
    j = F.explode(F.sequence(F.col("i"), F.col("blocks") - 1))
    numbered = buckets.select("parent", "bucket", "blocks", i.alias("i")).select("parent", "bucket", "blocks", "i", j.alias("j"))
    centre = numbered.join(hubs.select(F.col("grp").alias("parent"), "hub").distinct(), "parent")
    centre = centre.join(labels, centre["hub"] == labels["node"], "left").select(
        F.col("bucket").alias("grp"), (F.col("i") * F.col("blocks") + F.col("j")).alias("part"), F.lit(False).alias("split"),
        F.lit(0).alias("rank"), F.col("hub").alias("class"), F.coalesce("label", "hub").alias("label"),
    )
    return members.unionByName(centre).select(*_TASK)


def components(links: DataFrame, scratch: Scratch | None = None) -> DataFrame:
    """(node, label): the smallest node that each linked node can reach.

    In each round a node takes the smallest label around it, then the label of that label,
    until nothing changes.  Nothing but a count and a checksum reaches the driver.
    """
    scratch = scratch or Scratch(links.sparkSession)
    both = scratch.keep(links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    labels = scratch.keep(both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("node"), F.least("a", "m").alias("label")))
    state = _state(labels)
    while True:
        around = (
            both.join(labels, both["b"] == labels["node"])
            .select(F.col("a").alias("node"), "label")
            .unionByName(labels)
            .groupBy("node")
            .agg(F.min("label").alias("label"))
        )
        around = scratch.keep(around, labels)
        target = around.select(F.col("node").alias("label"), F.col("label").alias("next"))
        jumped = around.join(target, "label", "left").select("node", F.least("label", F.coalesce("next", "label")).alias("label"))
        labels = scratch.keep(jumped, around)
        before, state = state, _state(labels)
        if state == before:
            scratch.drop(both)
            return labels


def _state(labels: DataFrame) -> tuple:
    """Labels only fall, so an equal count and checksum tell that none did."""
    row = labels.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("node", "label")).alias("x")).first()
    return row["n"], row["x"]


def _groups(rows: DataFrame, scratch: Scratch) -> DataFrame:
    """From rows (bucket, member): (grp, hub, member), members without their hub.

    Buckets with the same members count once.  Buckets that have the same hub make one group, so a
    document stands in it once, however many buckets it shares with the hub.
    """
    sizes = rows.groupBy("bucket").agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("member")).alias("who")).where("n > 1")
    sizes = sizes.groupBy("n", "who").agg(F.min("bucket").alias("bucket"), F.count("*").alias("times"))
    met = scratch.keep(rows.join(sizes.select("bucket", (F.col("n") * F.col("times")).alias("n")), "bucket"))
    degrees = met.groupBy("member").agg(F.sum("n").alias("degree"))
    ranked = met.join(degrees, "member").select("bucket", "member", "degree")
    hubs = ranked.groupBy("bucket").agg(F.max(F.struct("degree", "member"))["member"].alias("hub"))
    grouped = met.join(hubs, "bucket").where(F.col("member") != F.col("hub")).select("hub", "member").distinct()
    return scratch.keep(grouped.select(F.xxhash64("hub").alias("grp"), "hub", "member"), met)


def near_duplicates(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", percent: int = 85, carry_key: bool = False
) -> DataFrame:
    """Per document: id, ``n_shingles``, ``component_id`` and ``kept``.

    ``component_id`` is the smallest id among the documents that links lead to, itself
    included; ``kept`` marks the document whose id that is.  A null or blank text has no
    shingle and is linked with nothing; its component is its own id.  Null ids are documents
    like others, with a null component only where no linked document has an id; then all of
    these count as kept.  Rows alike in id and text get the same result each.  Extra columns are
    left out.  ``carry_key`` adds the md5 of the text as ``text_key`` and a ``component_key`` that
    all rows of a component have, those without an id, too; rows without shingles have one together
    if they are alike in id and text.  An empty table gives no row.
    """
    scratch = Scratch(docs.sparkSession)
    rows = scratch.keep(signed(docs, doc_id, text))
    classes = scratch.keep(
        rows.where("size > 0")
        .groupBy("class")
        .agg(F.min(F.struct("id", "key")).alias("one"), F.min("id").alias("first_id"), F.first("bands").alias("bands"), F.max("size").alias("size"))
        .select("class", "one.id", "one.key", "first_id", "bands", "size")
    )
    groups = _groups(classes.select(F.explode("bands").alias("bucket"), F.col("class").alias("member")), scratch)
    labels = None
    if not groups.isEmpty():
        wanted = groups.select(F.col("member").alias("class")).unionByName(groups.select(F.col("hub").alias("class")))
        texts = scratch.keep(fetched(docs, classes, wanted, doc_id, text))
        results = scratch.keep(compared(texts, _first_tasks(groups, classes), percent))
        links = results.where(F.col("b").isNotNull()).select("a", "b")
        labels = components(links, scratch)
        open_ = results.where(F.col("b").isNull()).select("grp", "a", "prefix")
        if not open_.isEmpty():
            again = scratch.keep(compared(texts, _last_tasks(open_, groups, classes, labels, scratch), percent))
            if not again.isEmpty():
                # What the first round joined is a star around each label by now.
                stars = labels.where("node <> label").select(F.col("node").alias("a"), F.col("label").alias("b"))
                labels = components(stars.unionByName(again.select("a", "b")), scratch)
        scratch.drop(texts, groups)
    named = classes.select("class", "first_id")
    if labels is not None:
        joined = named.join(labels, named["class"] == labels["node"], "left")
        joined = joined.select("class", "first_id", F.coalesce("label", "class").alias("label"))
        least = joined.groupBy("label").agg(F.min("first_id").alias("component"))
        named = joined.join(least, "label").select("class", "component", "label")
    else:
        named = named.select("class", F.col("first_id").alias("component"), F.col("class").alias("label"))
    out = rows.join(named, "class", "left")
    component = F.when(F.col("size") > 0, F.col("component")).otherwise(F.col("id"))
    own = F.concat_ws(":", F.lit("none"), F.col("id").cast("string"), F.col("key"))
    together = F.when(F.col("size") > 0, F.hex("label")).otherwise(own)
    extra = [F.col("key").alias("text_key"), together.alias("component_key")] if carry_key else []
    return out.select(
        F.col("id").alias(doc_id), F.col("size").alias("n_shingles"), component.alias("component_id"),
        F.col("id").eqNullSafe(component).alias("kept"), *extra,
    )
