"""Incremental loading: watermarks, batch columns and tolerant column lists."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping
from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# --- Fixed values -----------------------------------------------------------------
FIRST_WATERMARK = "1900-01-01 00:00:00"
# --- end of fixed values ------------------------------------------------------------


def with_columns_of(df: DataFrame, wanted: Mapping[str, str] | list[str]) -> DataFrame:
    """Exactly the wanted columns, in order; ones the source lacks are typed NULLs."""
    types = wanted if isinstance(wanted, Mapping) else dict.fromkeys(wanted, "string")
    return df.select(
        *[
            (F.col(name) if name in df.columns else F.lit(None).cast(dtype)).alias(name)
            for name, dtype in types.items()
        ]
    )


def add_batch_columns(df: DataFrame, source: str, batch_id: str | None = None) -> DataFrame:
    """When, whence and in which batch rows came; one id for the whole batch."""
    if batch_id is None:
        batch_id = f"batch_{datetime.now(timezone.utc):%Y%m%d_%H%M%S}_{uuid.uuid4()}"
    return df.withColumns(
        {
            "_ingested_at": F.current_timestamp(),
            "_source": F.lit(source),
            "_batch_id": F.lit(batch_id),
        }
    )


def high_watermark(
    spark: SparkSession, table: str | DataFrame, column: str, first: str | None = FIRST_WATERMARK
):
    """Largest value seen so far; ``first`` when the table is empty or not there.

    Only a missing table counts as a first run.  Any other failure is raised, so that an
    outage can never start a full reload.
    """
    if isinstance(table, str):
        if not spark.catalog.tableExists(table):
            return first
        table = spark.table(table)
    newest = table.agg(F.max(column).alias("newest")).first()["newest"]
    return first if newest is None else newest


def increment(
    source: DataFrame,
    target: DataFrame,
    column: str,
    overlap: timedelta | None = None,
    keys: list[str] | None = None,
    limit: int | None = None,
) -> DataFrame:
    """Source rows past the target's largest ``column``, found by a scalar subquery.

    Rows sharing the largest value can arrive after it was read.  ``overlap`` looks back
    that far and leaves out what the target already has, compared by ``keys`` and
    ``column``; only that slice of the target is scanned.  ``limit`` takes about so many of
    the oldest rows: all that share the last of these rows' value come along, since the next
    run starts behind it.
    """
    floor = target.agg(F.max(column)).scalar()
    if overlap is not None:
        floor = floor - F.make_dt_interval(secs=F.lit(overlap.total_seconds()))
    fresh = source.where(floor.isNull() | (F.col(column) > floor))
    if overlap is not None:
        if not keys:
            raise ValueError("overlap needs the keys that identify a row")
        seen = target.where(F.col(column) > floor).select(*keys, column)
        fresh = fresh.join(seen, [*keys, column], "left_anti")
    if limit is not None:
        edge = fresh.where(F.col(column).isNotNull()).select(column).orderBy(column).limit(limit).agg(F.max(column))
        fresh = fresh.where(F.col(column).isNull() | (F.col(column) <= edge.scalar()))
    return fresh


def load_increment(
    spark: SparkSession,
    target: str,
    column: str,
    read: Callable[[str | None], DataFrame],
    source: str,
    first: str | None = FIRST_WATERMARK,
) -> DataFrame:
    """Read past the target's watermark and add batch columns (also when nothing is new)."""
    watermark = high_watermark(spark, target, column, first)
    return add_batch_columns(read(watermark), source)
