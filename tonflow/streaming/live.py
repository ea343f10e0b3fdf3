"""Streaming queries over growing tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from tonflow.operators.quality import expect_or_drop
from tonflow.plans import speed, tracking

# --- Fixed values -----------------------------------------------------------------
LATENESS = "30 seconds"
# --- end of fixed values ------------------------------------------------------------


def file_stream(
    spark: SparkSession, path: str, schema, fmt: str = "parquet", files_per_batch: int | None = None
) -> DataFrame:
    """A folder that files are added to, as a stream."""
    reader = spark.readStream.format(fmt).schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(path)


def table_stream(spark: SparkSession, table: str, files_per_batch: int | None = None) -> DataFrame:
    """A catalog table that rows are appended to, as a stream."""
    reader = spark.readStream
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.table(table)


def event_time(df: DataFrame, column: str, lateness: str = LATENESS) -> DataFrame:
    """Watermark on a time column; later rows are dropped, as there is no side output.

    Parquet times without a zone arrive as TIMESTAMP_NTZ, which a watermark refuses.
    """
    return df.withColumn(column, F.col(column).cast("timestamp")).withWatermark(column, lateness)


def spacing_stream(
    positions: DataFrame,
    devices: DataFrame,
    lanes: DataFrame,
    geofences: DataFrame | None = None,
    lateness: str = LATENESS,
    one_per_truck: bool = False,
) -> DataFrame:
    """Spacing of following trucks as windows of five seconds close (append output).

    Finding the lane is stateless: an equi-join with the static grid of lanes.  The positions
    of a window, direction and stretch of road are then put in driving order, and a second pass
    joins each stretch to the next by the trucks at its ends: no state row holds more than the
    positions of one stretch within five seconds, or two trucks of each stretch.  With
    ``one_per_truck`` an aggregation before that keeps a truck's last position only.
    """
    typed = event_time(tracking.typed_positions(positions), "devicetime", lateness)
    located = tracking.located_positions(typed, devices, tracking.lane_lookup(lanes))
    ordered = tracking.driving_order(located)
    position, when = F.struct(*tracking.TRUCK_FIELDS), F.window("devicetime", tracking.PAIR_WINDOW)
    if one_per_truck:
        ordered = ordered.groupBy(when.alias("_w"), "jalur_arah", "truk").agg(
            F.max_by(F.struct(position.alias("at"), tracking.road_cell().alias("cell")), F.struct("devicetime", "id")).alias("_last")
        )
        ordered = ordered.select("_w", "jalur_arah", F.col("_last.at").alias("_truck"), F.col("_last.cell").alias("_cell"))
        position, when = F.col("_truck"), F.window(F.window_time("_w"), tracking.PAIR_WINDOW)
    ordered = ordered.withColumn("_cell", F.col("_cell") if one_per_truck else tracking.road_cell())
    queues = ordered.groupBy(when.alias("_w2"), "jalur_arah", "_cell").agg(
        F.sort_array(F.collect_list(position)).alias("_queue")
    )
    # Pairs within a stretch, and its first and last truck (part NULL).
    inside = F.transform(
        _neighbours("_queue"), lambda p: F.struct(F.col("_cell").alias("part"), p["one"].alias("behind"), p["two"].alias("ahead"))
    )
    ends = F.struct(
        F.lit(None).cast("long").alias("part"), F.element_at("_queue", 1).alias("behind"), F.element_at("_queue", -1).alias("ahead")
    )
    parts = queues.select("_w2", "jalur_arah", F.inline(F.array_append(inside, ends)).alias("part", "behind", "ahead"))
    # The second pass holds pairs by stretch, and of all stretches the two trucks at the ends.
    met = parts.groupBy(F.window(F.window_time("_w2"), tracking.PAIR_WINDOW).alias("_w3"), "jalur_arah", "part").agg(
        F.sort_array(F.collect_list(F.struct("behind", "ahead"))).alias("_pairs")
    )
    across = F.transform(
        _neighbours("_pairs"), lambda p: F.struct(p["one"]["ahead"].alias("behind"), p["two"]["behind"].alias("ahead"))
    )
    pairs = met.select(F.inline(F.when(F.col("part").isNull(), across).otherwise(F.col("_pairs"))))
    pairs = pairs.toDF("behind", "ahead")
    spacing = tracking.measured_pairs(pairs)
    return spacing if geofences is None else tracking.with_geofences(spacing, geofences)


def _neighbours(items: str) -> Column:
    """Each element with the one after it, as an array of structs (one, two)."""
    n = F.size(items) - 1
    return F.arrays_zip(F.slice(items, F.lit(1), n).alias("one"), F.slice(items, F.lit(2), n).alias("two"))


def rollup_stream(spacing: DataFrame, kind: str, lateness: str = LATENESS) -> DataFrame:
    """Five-minute averages over a stream of spacing rows."""
    return tracking.windowed_rollup(
        tracking.with_labels(event_time(spacing, "devicetime", lateness)), kind
    )


def overall_stream(spacing: DataFrame, kind: str) -> DataFrame:
    """Averages over all time; rows without a time are dropped.  Complete or update output."""
    timed = expect_or_drop(spacing, valid_devicetime="devicetime IS NOT NULL")
    return tracking.overall_rollup(tracking.with_labels(timed, "Unknown"), kind)


def speed_stream(bronze: DataFrame) -> DataFrame:
    """Incremental, stateless cleaning of closing transactions."""
    return speed.closing_silver(bronze)


def to_files(
    df: DataFrame, path: str, checkpoint: str, once: bool = True, fmt: str = "parquet"
) -> StreamingQuery:
    """Append to a folder; ``once`` works off what is there and stops."""
    writer = df.writeStream.format(fmt).outputMode("append").option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start(path)


def to_table(
    df: DataFrame, table: str, checkpoint: str, once: bool = True, mode: str = "append"
) -> StreamingQuery:
    """Append to a catalog table."""
    writer = df.writeStream.outputMode(mode).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).toTable(table)
