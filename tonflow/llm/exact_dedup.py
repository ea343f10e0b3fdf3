"""Exact deduplication of arriving batches against immutable snapshots.

A batch is reduced to the digests of its texts, blanks deleted, and texts alike within the batch
are grouped first (partial aggregates, so a text that a third of all rows share is one row per
task).  Each snapshot, that is a batch taken in earlier, has exact buckets (digests by range of a
64-bit key) and for every bucket a static binary-fuse filter.  The keys of a new batch meet the
filters of their buckets; what passes is joined to the exact buckets by its whole digest, and texts
that agree there are fetched from both sides and compared byte by byte.  Texts found in no snapshot
are the new snapshot, with filters of its own; older ones are never rewritten.

Snapshots hold digests, not texts: texts stay in the batch they came with and are read again for the
byte checks only.

Defined results
  * A null text is an empty one; empty texts are alike.
  * Of rows alike the one with the most code points stays, then the smallest id (none last); of rows
    alike in these, too, exactly one stays, and which one shows in no column.
  * ``keep_id`` is the id of the row that stays, null where it has none.
  * An empty batch makes an empty snapshot.  Only id and text are read; other columns may have
    any names.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tonflow.llm.binary_fuse import BinaryFuse, build
from tonflow.llm.common import code_on_workers, stored

#: Deleted before texts are compared.
BLANKS = " \t\n\x0b\x0c\r"
#: Keys of one bucket, and keys that meet a filter in one task, about.
KEYS_PER_BUCKET, KEYS_PER_TASK = 200_000, 1_000_000

_FILTER = "bucket int, seed string, segment int, segments int, fingerprints binary"


@dataclass
class Snapshot:
    """An immutable batch: its rows, its texts that no earlier snapshot has, and their filters.

    ``rows``: (id, digest, home, row, longest) of every row; ``home`` is the snapshot its text first stood in.
    ``texts``: (digest, key, bucket, number of rows, first row in order of preference) of the new texts.
    """

    number: int
    docs: DataFrame
    rows: DataFrame
    texts: DataFrame
    filters: DataFrame
    buckets: int


def normalised(text: Column) -> Column:
    return F.translate(F.coalesce(text, F.lit("")), BLANKS, "")


def _preference() -> Column:
    """The least is the row that stays."""
    return F.struct((-F.col("longest")).alias("shortfall"), F.col("id").isNull().alias("no_id"), "id", "row")


def _bucket(buckets: int) -> Column:
    """A range of keys, so that a bucket's keys lie together."""
    return F.shiftrightunsigned(F.shiftrightunsigned("key", 32) * F.lit(buckets).cast("long"), 32).cast("int")


def take_in(docs: DataFrame, earlier: list[Snapshot], doc_id: str = "doc_id", text: str = "text") -> Snapshot:
    """The snapshot of a batch; its texts that ``earlier`` ones hold are left to those."""
    code_on_workers(docs.sparkSession)
    docs = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text"))
    plain = normalised(F.col("text"))
    digests = docs.select(
        "id", F.sha2(plain, 256).alias("digest"), F.xxhash64(plain).alias("key"), F.length(F.coalesce("text", F.lit(""))).alias("longest")
    )
    rows = stored(digests.withColumn("row", F.monotonically_increasing_id()))
    groups = rows.groupBy("digest", "key").agg(F.count("*").alias("n"), F.min(_preference()).alias("first"))
    groups = stored(groups) if earlier else groups
    homes = None
    for snapshot in earlier:
        found = _found(groups, docs, snapshot).select("digest", F.lit(snapshot.number).alias("home"))
        homes = found if homes is None else homes.unionByName(found)
    number = len(earlier)
    if homes is None:
        fresh = groups
        rows = rows.withColumn("home", F.lit(number))
    else:
        homes = stored(homes)
        fresh = groups.join(homes, "digest", "left_anti")
        rows = rows.join(homes, "digest", "left").withColumn("home", F.coalesce("home", F.lit(number)))
    fresh = stored(fresh)
    buckets = max(1, -(-fresh.count() // KEYS_PER_BUCKET))
    texts = fresh.withColumn("bucket", _bucket(buckets))
    filters = texts.select("bucket", "key").groupBy("bucket").applyInArrow(_build, _FILTER)
    return Snapshot(number, docs, rows, texts, stored(filters), buckets)


def screen(keys: DataFrame, snapshot: Snapshot) -> DataFrame:
    """The rows of ``keys`` (with a column ``key``) that the snapshot's filters let pass.

    Keys are hashes of distinct texts, so buckets are even; where the batch is much larger than the
    snapshot, copies of a bucket's filter share its keys.
    """
    parts = max(1, -(-keys.count() // (snapshot.buckets * KEYS_PER_TASK)))
    part = F.pmod(F.hash("key"), F.lit(parts)) if parts > 1 else F.lit(0)
    dealt = keys.select("key", _bucket(snapshot.buckets).alias("bucket"), part.alias("part"))
    copies = snapshot.filters.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
    passed = (
        copies.groupBy("bucket", "part")
        .cogroup(dealt.groupBy("bucket", "part"))
        .applyInArrow(_screen, "key long")
    )
    return keys.join(passed.distinct(), "key", "left_semi")


def _found(groups: DataFrame, docs: DataFrame, snapshot: Snapshot) -> DataFrame:
    """Digests of the batch's texts that the snapshot holds, byte by byte."""
    positives = screen(groups.select("digest", "key", F.col("first.id").alias("id")), snapshot)
    exact = snapshot.texts.select("digest", "key", F.col("first.id").alias("held_id"))
    pairs = stored(positives.join(exact, ["digest", "key"]))
    here = _texts(docs, pairs.select("digest", "id"), 1)
    there = _texts(snapshot.docs, pairs.select("digest", F.col("held_id").alias("id")), 2)
    compared = here.unionByName(there).groupBy("digest").agg(
        F.bit_or("side").alias("sides"), (F.min("plain") == F.max("plain")).alias("alike")
    )
    return compared.where((F.col("sides") == 3) & F.col("alike")).select("digest")


def _texts(docs: DataFrame, wanted: DataFrame, side: int) -> DataFrame:
    """Texts, blanks deleted, of one row for each wanted digest.

    Texts meet their digests in a shuffle at every size: the number wanted grows with the batch.
    """
    plain = docs.select("id", normalised(F.col("text")).alias("plain")).withColumn("digest", F.sha2("plain", 256))
    wanted = wanted.select("digest", F.col("id").alias("wanted_id"))
    met = plain.join(wanted.hint("merge"), "digest").where(F.col("id").eqNullSafe(F.col("wanted_id")))
    return met.select("digest", "plain", F.lit(side).alias("side"))


def verdicts(snapshots: list[Snapshot]) -> DataFrame:
    """(id, keep_id, group_size, kept, digest) of every row of all snapshots."""
    rows = None
    for s in snapshots:
        own = s.rows.withColumn("number", F.lit(s.number))
        rows = own if rows is None else rows.unionByName(own)
    rows = rows.select("id", "digest", "home", "longest", F.struct("number", "row").alias("row"))
    groups = rows.groupBy("digest", "home").agg(F.count("*").alias("n"), F.min(_preference()).alias("first"))
    several = stored(groups.where("n > 1").select("digest", "home", "n", F.col("first.id").alias("keep_id"), F.col("first.row").alias("keep_row")))
    met = rows.join(several, ["digest", "home"], "left")
    single = F.col("n").isNull()
    return met.select(
        "id", F.when(single, F.col("id")).otherwise(F.col("keep_id")).alias("keep_id"), F.coalesce("n", F.lit(1)).alias("group_size"),
        (single | (F.col("row") == F.col("keep_row"))).alias("kept"), "digest",
    )


def deduplicate(batches: list[DataFrame], doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """:func:`verdicts` on batches taken in one after the other."""
    snapshots: list[Snapshot] = []
    for batch in batches:
        snapshots.append(take_in(batch, snapshots, doc_id, text))
    return verdicts(snapshots)


# ------------------------------------------------------------------------ in the tasks
def _build(keys: pa.Table) -> pa.Table:
    made = build(keys.column("key").to_numpy())
    row = {
        "bucket": [keys.column("bucket")[0].as_py()], "seed": [str(made.seed)], "segment": [made.segment], "segments": [made.segments],
        "fingerprints": [made.fingerprints.tobytes()],
    }
    types = [pa.int32(), pa.string(), pa.int32(), pa.int32(), pa.binary()]
    return pa.table({c: pa.array(v, t) for (c, v), t in zip(row.items(), types)})


def _screen(filters: pa.Table, keys: pa.Table) -> pa.Table:
    if not filters.num_rows or not keys.num_rows:
        return pa.table({"key": pa.array([], pa.int64())})
    f = filters.to_pylist()[0]
    held = BinaryFuse(int(f["seed"]), f["segment"], f["segments"], np.frombuffer(f["fingerprints"], np.uint8))
    key = keys.column("key").to_numpy()
    return pa.table({"key": pa.array(key[held.may_hold(key)])})
