"""Operators over rows in order: previous row, nearest match, running total, numbering.

A window over a key puts all rows of that key into one task, which fails when one key
holds a large part of the table.  The operators here cut every key into slots of time (or
of any order-preserving number), scan each slot on its own, and hand one row per slot to
the next: the last row seen, or the total so far.  Those hand-over rows come from a
pre-aggregation, so only one row per key and slot is ever ordered across slots, and the
result is exactly that of the plain window.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tonflow.functions.numbers import col
from tonflow.sources.session import cut_lineage

SALTS = 256


def time_slot(ts: Column | str, minutes: float) -> Column:
    """Number of the time slot a timestamp falls into; grows with time."""
    width = int(minutes * 60_000_000)
    return F.floor(F.unix_micros(col(ts).cast("timestamp")) / F.lit(width))


def number_slot(value: Column | str, width: float) -> Column:
    return F.floor(col(value) / F.lit(width))


def _spread_nulls(slot: Column, *by) -> Column:
    """Rows that have no place in the order are spread instead of forming one group."""
    return F.coalesce(slot, -1 - F.pmod(F.xxhash64(*by), F.lit(SALTS)))


def previous_row(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    fields: Sequence[str],
    slot: Column,
    name: str = "previous",
) -> DataFrame:
    """Add a struct of ``fields`` taken from the row just before; NULL for the first row.

    ``slot`` must not decrease along ``order``.  A row whose slot is NULL (no time) has no
    place in the order: it gets no previous row and is nobody's previous row.
    """
    keys, order = list(keys), list(order)
    rows = df.withColumns(
        {
            "_placed": slot.isNotNull(),
            "_slot": _spread_nulls(slot, *keys, *order),
            "_own": F.struct(*fields),
            "_real": F.lit(1),
        }
    )
    tails = (
        rows.where("_placed")
        .groupBy(*keys, "_slot")
        .agg(F.max_by("_own", F.struct(*order)).alias("_tail"))
    )
    across = W.partitionBy(*keys).orderBy("_slot")
    heads = tails.select(
        *keys,
        F.lit(True).alias("_placed"),
        "_slot",
        F.lag("_tail").over(across).alias("_own"),
        F.lit(0).alias("_real"),
    ).where("_own IS NOT NULL")
    within = W.partitionBy(*keys, "_placed", "_slot").orderBy("_real", *order)
    return (
        rows.unionByName(heads, allowMissingColumns=True)
        .withColumn(name, F.when(F.col("_placed"), F.lag("_own").over(within)))
        .where("_real = 1")
        .drop("_placed", "_slot", "_own", "_real")
    )


def counter_delta(
    df: DataFrame,
    keys: Sequence[str],
    ts: str,
    counter: str,
    delta: str = "delta_volume",
    seconds: str = "time_delta_seconds",
    ties: Sequence[str] = (),
    slot_minutes: float = 60.0,
) -> DataFrame:
    """Growth of a cumulative counter since the reading before, and the time it took.

    NULL growth for the first reading, for a missing reading on either side, and when the
    counter went back (a reset).
    """
    with_previous = previous_row(
        df, keys, [ts, *ties], [ts, counter], time_slot(ts, slot_minutes), "_previous"
    )
    before, now = F.col(f"_previous.{counter}"), F.col(counter)
    elapsed = F.unix_seconds(F.col(ts)) - F.unix_seconds(F.col(f"_previous.{ts}"))
    return with_previous.withColumns(
        {seconds: elapsed, delta: F.when(now >= before, (now - before).cast("double"))}
    ).drop("_previous")


def drop_repeats(
    df: DataFrame,
    keys: Sequence[str],
    ts: str,
    closed: str,
    minutes: float = 20.0,
    ties: Sequence[str] = (),
    slot_minutes: float = 60.0,
) -> DataFrame:
    """Drop a row that follows the previous raw row of its key within ``minutes`` while its
    own ``closed`` column is still empty.

    The previous row counts whether or not it is itself dropped.  Rows without a key or a
    time are kept.
    """
    with_previous = previous_row(
        df, keys, [ts, *ties], [ts], time_slot(ts, slot_minutes), "_previous"
    )
    gap = (F.unix_micros(F.col(ts)) - F.unix_micros(F.col(f"_previous.{ts}"))) / 60_000_000.0
    keyed = F.lit(True)
    for k in keys:
        keyed = keyed & F.col(k).isNotNull()
    repeated = keyed & (gap <= minutes) & F.col(closed).isNull()
    return with_previous.where(~F.coalesce(repeated, F.lit(False))).drop("_previous")


@dataclass(frozen=True)
class Leg:
    """One kind of event to match each left row with.

    ``direction`` is ``backward`` (at or before the left row) or ``forward`` (at or after).
    ``fields`` are the columns handed over.  ``when`` is a condition on the left row; where
    it fails the row stays but matches nothing.  Events at the same time are told apart by
    the smallest ``tie``.
    """

    name: str
    rows: DataFrame
    ts: str
    direction: str
    tie: str
    fields: Sequence[str] = field(default_factory=list)
    when: Column | None = None


def match_nearest(
    left: DataFrame,
    by: Sequence[str],
    ts: str,
    legs: Sequence[Leg],
    within_hours: float,
    slot_minutes: float = 60.0,
) -> DataFrame:
    """For every left row and leg, the nearest event of the same key within a time limit.

    Adds one struct column per leg (NULL when nothing matches); no left row is lost or
    repeated.  All legs share one union, one shuffle on (key, slot) and two sorts, so
    nothing fans out the way a range join does.
    """
    by, left_columns = list(by), left.columns
    keyed = F.lit(True)
    for k in by:
        keyed = keyed & F.col(k).isNotNull()

    # Columns of map type can't be hashed.
    spread_by = [f.name for f in left.schema.fields if "map<" not in f.dataType.simpleString()]
    place = _spread_nulls(time_slot(ts, slot_minutes), *spread_by)
    stream = left.select(
        *by,
        place.alias("_slot"),
        F.col(ts).cast("timestamp").alias("_ts"),
        F.lit(1).alias("_rank"),
        F.lit(None).cast("long").alias("_tie"),
        F.struct(*left_columns).alias("_left"),
    )
    for leg in legs:
        events = leg.rows.where(F.col(leg.ts).isNotNull() & keyed)
        stream = stream.unionByName(
            events.select(
                *by,
                time_slot(leg.ts, slot_minutes).alias("_slot"),
                F.col(leg.ts).cast("timestamp").alias("_ts"),
                # At equal times an event must lie on the side it is looked for.
                F.lit(0 if leg.direction == "backward" else 2).alias("_rank"),
                F.col(leg.tie).cast("long").alias("_tie"),
                F.struct(F.col(leg.ts).alias("_at"), *leg.fields).alias(leg.name),
            ),
            allowMissingColumns=True,
        )

    # One row per key and slot: the event each leg would hand to a neighbouring slot.
    nearest_edge = {
        "backward": F.struct(F.col("_ts"), -F.col("_tie")),
        "forward": F.struct(-F.unix_micros("_ts"), -F.col("_tie")),
    }

    def edge(leg: Leg) -> Column:
        place = F.when(F.col(leg.name).isNotNull(), nearest_edge[leg.direction])
        return F.max_by(F.col(leg.name), place).alias(leg.name)

    edges = stream.groupBy(*by, "_slot").agg(
        F.max(F.col("_rank") == 1).alias("_wanted"), *[edge(leg) for leg in legs]
    )
    before = W.unboundedPreceding, -1
    across = {
        "backward": W.partitionBy(*by).orderBy("_slot").rowsBetween(*before),
        "forward": W.partitionBy(*by).orderBy(F.desc("_slot")).rowsBetween(*before),
    }
    handed = edges.select(
        *by,
        "_slot",
        "_wanted",
        F.lit(3).alias("_rank"),
        *[
            F.last(leg.name, ignorenulls=True).over(across[leg.direction]).alias(leg.name)
            for leg in legs
        ],
    )
    stream = stream.unionByName(
        handed.where("_wanted").drop("_wanted"), allowMissingColumns=True
    )

    # Hand-over rows (rank 3) open the slot in both scan directions.
    opens = (F.col("_rank") != 3).cast("int")
    forwards = W.partitionBy(*by, "_slot").orderBy(
        opens, F.col("_ts"), F.col("_rank"), F.col("_tie").desc()
    )
    backwards = W.partitionBy(*by, "_slot").orderBy(
        opens, F.col("_ts").desc(), F.col("_rank").desc(), F.col("_tie").desc()
    )
    seen = {
        leg.name: F.last(leg.name, ignorenulls=True).over(
            (forwards if leg.direction == "backward" else backwards).rowsBetween(
                W.unboundedPreceding, W.currentRow
            )
        )
        for leg in legs
    }
    scanned = stream.withColumns(seen).where("_left IS NOT NULL")

    def accepted(leg: Leg) -> Column:
        event = F.col(leg.name)
        at, own = F.unix_micros(event["_at"].cast("timestamp")), F.unix_micros("_ts")
        gap = own - at if leg.direction == "backward" else at - own
        ok = gap.between(0, int(within_hours * 3_600_000_000))
        for k in by:
            ok = ok & F.col(k).isNotNull()
        picked = F.when(ok, F.struct(*[event[f].alias(f) for f in leg.fields]))
        return picked.alias(leg.name)

    matched = scanned.select("_left.*", *[accepted(leg) for leg in legs])
    conditional = {
        leg.name: F.when(leg.when, F.col(leg.name)) for leg in legs if leg.when is not None
    }
    return matched.withColumns(conditional) if conditional else matched


def asof_join(
    left: DataFrame,
    right: DataFrame,
    by: Sequence[str],
    left_ts: str,
    right_ts: str,
    tie: str,
    direction: str = "backward",
    within_hours: float = 8.0,
    fields: Sequence[str] | None = None,
    when: Column | None = None,
    slot_minutes: float = 60.0,
) -> DataFrame:
    """Left join with the nearest right row; the right ``fields`` become plain columns."""
    fields = list(fields if fields is not None else [c for c in right.columns if c not in by])
    leg = Leg("_match", right, right_ts, direction, tie, fields, when)
    matched = match_nearest(left, by, left_ts, [leg], within_hours, slot_minutes)
    return matched.select(*left.columns, *[F.col(f"_match.{f}").alias(f) for f in fields])


def dealt(df: DataFrame, order: Sequence[str | Column], slot: str = "_slot") -> DataFrame:
    """Rows dealt to numbered slots by ranges of a whole order key, written once.

    Spark samples the key for ranges of even size and merges small ones, so slots follow the
    data.  Rows that tie on the whole key share a slot, and slot numbers grow along the order.
    """
    return cut_lineage(df.repartitionByRange(*order).withColumn(slot, F.spark_partition_id()))


def running_total(
    df: DataFrame,
    order: Sequence[str],
    value: str,
    keys: Sequence[str] = (),
    name: str = "running_total",
    opening: float = 0.0,
) -> DataFrame:
    """Cumulative sum in order, within each key or over all rows, in two passes.

    Rows are dealt to slots by ranges of (keys, order).  Every slot is summed, the sums (one row
    per slot and key) are added up, and every slot then runs on from the total before it: no
    task holds more than a slot, however the rows are spread over keys and time.
    """
    keys, order = list(keys), list(order)
    rows = dealt(df.withColumns({"_add": F.col(value).cast("double"), "_real": F.lit(1)}), [*keys, *order])
    totals = rows.groupBy(*keys, "_slot").agg(F.sum("_add").alias("_sum"))
    # One row per slot: without keys they are ordered under one constant.
    across = W.partitionBy(*(keys or [F.lit(0)])).orderBy("_slot")
    earlier = F.sum("_sum").over(across.rowsBetween(W.unboundedPreceding, -1))
    heads = totals.select(
        *keys, "_slot", F.coalesce(earlier, F.lit(0.0)).alias("_add"), F.lit(0).alias("_real")
    )
    within = W.partitionBy(*keys, "_slot").orderBy("_real", *order)
    so_far = F.sum("_add").over(within.rowsBetween(W.unboundedPreceding, W.currentRow))
    return (
        rows.unionByName(heads, allowMissingColumns=True)
        .withColumn(name, so_far + F.lit(float(opening)))
        .where("_real = 1")
        .drop("_slot", "_add", "_real")
    )


def quantiles(
    df: DataFrame, keys: Sequence[str], value: str, fractions: Sequence[float], names: Sequence[str], between: bool = False
) -> DataFrame:
    """Exact quantiles of a value within each key, NULL values left out.

    Without ``between`` a quantile is the smallest value that the fraction of rows does not
    exceed (as ``percentile_disc``), with it neighbours are interpolated (``percentile``).

    Equal values are counted first, so only (key, value, count) is shuffled; these are dealt to
    slots by ranges of (key, value), and counts run on from slot to slot.  No task holds a
    key's values, and nothing is approximate at any size.
    """
    keys = list(keys)
    counts = df.where(F.col(value).isNotNull()).groupBy(*keys, F.col(value).alias("_v")).agg(F.count(F.lit(1)).alias("_n"))
    rows = dealt(counts, [*keys, "_v"])
    per_slot = rows.groupBy(*keys, "_slot").agg(F.sum("_n").alias("_in_slot"))
    # One row per key and slot.
    of_key = W.partitionBy(*(keys or [F.lit(0)]))
    before = F.sum("_in_slot").over(of_key.orderBy("_slot").rowsBetween(W.unboundedPreceding, -1))
    starts = per_slot.select(
        *[F.col(k).alias(f"_k_{k}") for k in keys], F.col("_slot").alias("_k_slot"), F.coalesce(before, F.lit(0)).alias("_start"),
        F.sum("_in_slot").over(of_key).alias("_all"),
    )
    on = F.col("_slot") == F.col("_k_slot")
    for k in keys:
        on = on & F.col(k).eqNullSafe(F.col(f"_k_{k}"))
    own = F.sum("_n").over(W.partitionBy(*keys, "_slot").orderBy("_v").rowsBetween(W.unboundedPreceding, 0))
    ranked = rows.withColumn("_own", own).join(starts, on).withColumn("_last", F.col("_start") + F.col("_own"))
    first = F.col("_last") - F.col("_n")  # this value stands at the places from here, from 0, up to before _last

    def at(place: Column) -> Column:
        return F.max(F.when((first <= place) & (place < F.col("_last")), F.col("_v")))

    found = []
    for i, f in enumerate(fractions):
        if between:
            place = (F.col("_all") - 1) * F.lit(float(f))
            found += [at(F.floor(place)).alias(f"_low{i}"), at(F.ceil(place)).alias(f"_high{i}"), F.max(place - F.floor(place)).alias(f"_part{i}")]
        else:
            found.append(at(F.greatest(F.ceil(F.col("_all") * F.lit(float(f))) - 1, F.lit(0))).alias(f"_low{i}"))
    picked = ranked.groupBy(*keys).agg(*found)
    out = []
    for i, n in enumerate(names):
        low = F.col(f"_low{i}")
        mixed = low + (F.col(f"_high{i}") - low) * F.col(f"_part{i}") if between else low
        out.append(mixed.alias(n))
    return picked.select(*keys, *out)


def row_numbers(df: DataFrame, order: Sequence[str], name: str = "row_number") -> DataFrame:
    """Position of every row under a total order, from 1, without one global sort task.

    Each slot of :func:`dealt` rows is numbered on its own and starts after the rows of the slots
    before it.  Keys may be of any orderable types, NULLs first.
    """
    order = list(order)
    rows = dealt(df, order)
    sizes = rows.groupBy("_slot").agg(F.count(F.lit(1)).alias("_rows"))
    # one row per slot
    earlier = W.partitionBy(F.lit(0)).orderBy("_slot").rowsBetween(W.unboundedPreceding, -1)
    starts = sizes.select("_slot", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_start"))
    own = F.row_number().over(W.partitionBy("_slot").orderBy(*order))
    numbered = rows.withColumn("_own", own).join(starts, "_slot")
    return numbered.select(*df.columns, (F.col("_start") + F.col("_own")).cast("long").alias(name))
