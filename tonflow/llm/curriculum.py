"""Mixing sources to target weights along a curriculum that changes over time.

Each source has a share of the training tokens and a schedule: its rate over training time
``t`` from 0 to 1 is ``1 + slope * (2t - 1)`` times its mean.  The integral of the schedule
is the part of its tokens a source has given by ``t``; inverting it assigns the token at a
given place of the source's stream its position in training.  Documents of a source stand in
its stream in hash order; passes over a source follow each other.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tonflow.llm.common import WORD, stored

ROWS_PER_PART = 20_000


def source_targets(
    sizes: DataFrame,
    weights: tuple[float, ...],
    share: float,
    most: float,
    slopes: tuple[float, ...],
) -> DataFrame:
    """Tokens to take from each source: by weight, none above ``most`` times its size.

    ``sizes`` has one row per source (source, source_size).  Sources in code-point order,
    null last, take the weights and slopes in turn.  What a source at its limit leaves over
    is shared by weight among the others: of all levels "rest of the tokens by rest of the
    weights", with sources counted as full in the order of limit by weight, the largest is
    the one at which exactly the right sources are full.
    """
    order = Window.orderBy(F.col("source").isNull(), F.col("source"))
    turn = F.row_number().over(order) - 1

    def cycle(values: tuple[float, ...]) -> Column:
        return F.element_at(F.array(*[F.lit(float(v)) for v in values]), (F.col("turn") % len(values)) + 1)

    filled = Window.orderBy(F.col("limit") / F.col("weight"), F.col("turn"))
    before = filled.rowsBetween(Window.unboundedPreceding, -1)
    all_rows = Window.partitionBy()
    nothing = F.lit(0.0)
    return (
        sizes.withColumn("turn", turn.cast("int"))
        .withColumn("weight", cycle(weights))
        .withColumn("slope", cycle(slopes))
        .withColumn("limit", F.lit(float(most)) * F.col("source_size"))
        .withColumn("tokens", F.lit(float(share)) * F.sum("source_size").over(all_rows))
        .withColumn("full", F.coalesce(F.sum("limit").over(before), nothing))
        .withColumn("spent", F.coalesce(F.sum("weight").over(before), nothing))
        .withColumn("level", (F.col("tokens") - F.col("full")) / (F.sum("weight").over(all_rows) - F.col("spent")))
        .withColumn("level", F.max("level").over(all_rows))
        .withColumn("target", F.least("limit", F.col("level") * F.col("weight")))
        .select("source", "source_size", "target", "slope")
    )


def position(given: Column, slope: Column) -> Column:
    """The time by which a source has given this part of its tokens (both 0 to 1)."""
    rest = 1 - slope
    root = F.sqrt(rest * rest + 4 * slope * given)
    return F.when(given <= 0, F.lit(0.0)).otherwise(2 * given / (rest + root))


def mix(
    docs: DataFrame,
    carry: tuple[str, ...] = ("doc_id",),
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    weights: tuple[float, ...] = (5.0, 2.0, 1.0),
    share: float = 1.5,
    most: float = 2.0,
    slopes: tuple[float, ...] = (-0.5, 0.0, 0.5),
) -> DataFrame:
    """Every document with its place in the mix.

    Returns the columns of ``carry`` and a struct ``mix``: size, source_size, target,
    taken (words, repeats counted), placements, an array of (pass, words, position), and ``tie``, which
orders documents of the same position (source, then md5 of id and of text).  The last
    document of a source is begun and not finished, so a source's taken words are its target
    rounded down.  A document of a size of nothing takes no place.  A null text has size 0;
    null sources form one source; ties in hash order are broken by id and text, and rows
    alike in both share nothing but their order.  An empty table gives no rows.

    A source's running sums never meet in one task: a source is cut into parts of its hash
    order, of about ``ROWS_PER_PART`` rows each, and parts get the sums of those before.
    """
    size = F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")
    key = F.md5(F.coalesce(F.col(doc_id).cast("string"), F.lit("")))
    sized = docs.select(
        F.struct(*carry).alias("row"), F.col(source).alias("source"), size.alias("size"), key.alias("key"),
        F.md5(F.coalesce(F.col(text), F.lit(""))).alias("text_key"),
    )
    digits = max(1, math.ceil(math.log(max(docs.count() / ROWS_PER_PART, 1), 16)))
    sized = sized.withColumn("part", F.substring("key", 1, digits))
    parts = stored(sized.groupBy("source", "part").agg(F.sum("size").alias("part_size")))
    sources = stored(
        source_targets(
            parts.groupBy("source").agg(F.sum("part_size").alias("source_size")), weights, share, most, slopes
        )
    )
    earlier = Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = parts.select(
        "source", "part", F.coalesce(F.sum("part_size").over(earlier), F.lit(0)).alias("offset")
    ).alias("o")
    offsets = offsets.join(sources.alias("s"), F.col("o.source").eqNullSafe(F.col("s.source"))).select(
        F.col("o.source").alias("of_source"), F.col("part").alias("of_part"), "offset", "source_size", "target", "slope"
    )
    within = Window.partitionBy("source", "part").orderBy("key", "text_key").rowsBetween(Window.unboundedPreceding, -1)
    start = F.col("offset") + F.coalesce(F.sum("size").over(within), F.lit(0))
    joined = sized.join(
        offsets, F.col("source").eqNullSafe(F.col("of_source")) & (F.col("part") == F.col("of_part"))
    ).withColumn("start", start)
    whole = F.floor("target").cast("long")

    def placement(i: Column) -> Column:
        at = i * F.col("source_size") + F.col("start")
        words = F.greatest(F.lit(0), F.least(F.col("size"), whole - at)).cast("long")
        when = position(F.try_divide(at, F.col("target")), F.col("slope"))
        return F.struct(i.cast("int").alias("pass"), words.alias("words"), when.alias("position"))

    passes = F.sequence(F.lit(0), F.lit(math.ceil(most) - 1))
    placements = F.filter(F.transform(passes, placement), lambda p: p["words"] > 0)
    return joined.withColumn("placements", placements).select(
        "row.*",
        F.struct(
            "size", "source_size", "target",
            F.aggregate("placements", F.lit(0).cast("long"), lambda a, p: a + p["words"]).alias("taken"),
            "placements",
            F.struct("source", "key", "text_key").alias("tie"),
        ).alias("mix"),
    )


def training_order(mixed: DataFrame) -> DataFrame:
    """A row for each pass over a document, in the order of training, by range and sorted.

    Adds ``position`` to the columns of ``mix``'s input; the text of a document that the mix
    only begins is handed over whole.
    """
    columns = [c for c in mixed.columns if c != "mix"]
    placed = mixed.select(
        F.struct(*columns).alias("row"), F.col("mix.tie").alias("tie"), F.explode("mix.placements").alias("placement")
    )
    order = ["placement.position", "tie.source", "tie.key", "tie.text_key", "placement.pass"]
    ordered = placed.repartitionByRange(*order).sortWithinPartitions(*order)
    return ordered.select("row.*", F.col("placement.position").alias("position"))
