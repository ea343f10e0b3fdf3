"""Several flows appending to one table: one-off backfills and recurring increments.

Every run of a flow is a batch.  It is announced in the target's log, its rows are appended under
its own batch id, and then it is logged as done.  A run that dies between these steps leaves
an announced batch that is not done; the next run takes its rows out again before anything else,
so a repeated run never doubles a batch, and readers of :func:`committed` never see half of one.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tonflow.operators.tables import delete_where, replace_table
from tonflow.sources.increments import add_batch_columns, high_watermark

BEGUN, DONE, UNDONE = "begun", "done", "undone"
BATCH = "_batch_id"


@dataclass(frozen=True)
class AppendFlow:
    """A named way of adding rows to a table.

    ``read`` gets the largest value of ``watermark`` in the target (None on a first run, or
    always for a flow without a watermark) and returns new rows.  A flow with ``once`` runs
    a single time in the life of the target.
    """

    name: str
    read: Callable[[object | None], DataFrame]
    source: str
    once: bool = False
    watermark: str | None = None


def log_name(target: str) -> str:
    return f"{target}_flows"


def _log(spark: SparkSession, target: str, flow: str, batch: str, state: str) -> None:
    """One row, so one file: it is there or it is not."""
    row = spark.range(1, numPartitions=1).select(
        F.lit(flow).alias("flow"), F.lit(batch).alias("batch"), F.lit(state).alias("state"), F.current_timestamp().alias("at")
    )
    row.write.mode("append").saveAsTable(log_name(target))


def _batches(spark: SparkSession, target: str) -> DataFrame | None:
    """(batch, flow, states) of all runs so far."""
    if not spark.catalog.tableExists(log_name(target)):
        return None
    spark.catalog.refreshTable(log_name(target))
    rows = spark.table(log_name(target))
    return rows.groupBy("batch").agg(F.min("flow").alias("flow"), F.collect_set("state").alias("states"))


def clean_up(spark: SparkSession, target: str) -> list[str]:
    """Take out the rows of batches that were announced but not finished; their ids."""
    batches = _batches(spark, target)
    if batches is None:
        return []
    over = F.array_contains("states", DONE) | F.array_contains("states", UNDONE)
    open_batches = [(r["batch"], r["flow"]) for r in batches.where(~over).collect()]
    for batch, flow in open_batches:
        if spark.catalog.tableExists(target):
            spark.catalog.refreshTable(target)
            parts = [c.name for c in spark.catalog.listColumns(target) if c.isPartition]
            if parts == [BATCH]:
                # Files that were written but not yet made known count as well.
                spark.sql(f"MSCK REPAIR TABLE {target}")
                spark.sql(f"ALTER TABLE {target} DROP IF EXISTS PARTITION ({BATCH} = '{batch}')")
            else:
                replace_table(delete_where(spark.table(target), F.col(BATCH) == batch), target)
        _log(spark, target, flow, batch, UNDONE)
    return [batch for batch, _ in open_batches]


def committed(spark: SparkSession, target: str) -> DataFrame:
    """The rows of finished batches, and those that no flow has written."""
    rows, batches = spark.table(target), _batches(spark, target)
    if batches is None:
        return rows
    unfinished = batches.where(~F.array_contains("states", DONE)).select(F.col("batch").alias(BATCH))
    return rows.join(unfinished, BATCH, "left_anti").select(*rows.columns)


def run_flow(spark: SparkSession, target: str, flow: AppendFlow) -> bool:
    """Run one flow; False when it was a one-off that had already run."""
    clean_up(spark, target)
    batches = _batches(spark, target)
    if flow.once and batches is not None:
        if not batches.where((F.col("flow") == flow.name) & F.array_contains("states", DONE)).isEmpty():
            return False
    since = high_watermark(spark, target, flow.watermark, None) if flow.watermark else None
    batch = f"{flow.name}_{uuid.uuid4().hex}"
    rows = add_batch_columns(flow.read(since), flow.source, batch)
    _log(spark, target, flow.name, batch, BEGUN)
    # A table made here is partitioned by batch, so that a batch can be taken out as a whole.
    writer = rows.write.mode("append")
    if spark.catalog.tableExists(target):
        parts = [c.name for c in spark.catalog.listColumns(target) if c.isPartition]
        writer = writer.partitionBy(*parts) if parts else writer
    else:
        writer = writer.partitionBy(BATCH)
    writer.saveAsTable(target)
    _log(spark, target, flow.name, batch, DONE)
    return True


def run_flows(spark: SparkSession, target: str, flows: Sequence[AppendFlow]) -> list[str]:
    """Run flows in order; the names of those that did something."""
    return [flow.name for flow in flows if run_flow(spark, target, flow)]
