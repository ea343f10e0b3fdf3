"""Catalog tables with fallbacks."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tonflow.functions.numbers import rsum


def table_exists(spark: SparkSession, name: str | None) -> bool:
    return bool(name) and spark.catalog.tableExists(name)


def resolve(
    spark: SparkSession,
    table: str | None,
    path: str,
    reader: Callable[[SparkSession, str], DataFrame],
) -> tuple[DataFrame, str]:
    """The catalog table when there is one, else the file; with a note of which it was."""
    if table_exists(spark, table):
        return spark.table(table), f"TABLE:{table}"
    return reader(spark, path), f"FILE:{path}"


def optional_table(spark: SparkSession, name: str | None, required: Iterable[str]) -> DataFrame | None:
    """A side table if it exists and has the columns needed, else None."""
    if not table_exists(spark, name):
        return None
    table = spark.table(name)
    return table if set(required) <= set(table.columns) else None


def first_usable(
    spark: SparkSession,
    candidates: Iterable[Mapping[str, str]],
    fallback: DataFrame | None = None,
    factor: float = 1.0,
) -> DataFrame:
    """Daily shipment from the first usable table of an ordered list.

    Each candidate gives ``table``, ``date_col`` and ``ton_col``; it is usable when it
    exists and has both columns.  Otherwise ``fallback`` (production_date, cp_intake_ton)
    times ``factor`` stands in and is flagged as estimated; without a fallback the result
    is empty.
    """
    for c in candidates:
        table = optional_table(spark, c["table"], (c["date_col"], c["ton_col"]))
        if table is None:
            continue
        daily = table.select(
            F.col(c["date_col"]).try_cast("date").alias("production_date"),
            F.col(c["ton_col"]).try_cast("double").alias("ton"),
        ).where("production_date IS NOT NULL")
        return daily.groupBy("production_date").agg(
            rsum("ton").alias("shipment_ton"),
            F.lit(False).alias("is_estimated"),
            F.lit(f"{c['table']}.{c['ton_col']}").alias("shipment_source"),
        )
    if fallback is None:
        return spark.createDataFrame(
            [],
            "production_date date, shipment_ton double, is_estimated boolean, shipment_source string",
        )
    return estimated_shipment(fallback, factor)


def estimated_shipment(intake: DataFrame, factor: float) -> DataFrame:
    """Shipment estimated as plant intake times a recovery factor, flagged as such."""
    return intake.select(
        "production_date",
        F.round(F.col("cp_intake_ton") * factor, 3).alias("shipment_ton"),
        F.lit(True).alias("is_estimated"),
        F.lit(f"ESTIMATED = cp_intake x {factor}").alias("shipment_source"),
    )


def inline_rows(spark: SparkSession, rows: list, schema: str | T.StructType) -> DataFrame:
    """A few literal rows (check results, configuration) with an explicit schema."""
    return spark.createDataFrame(rows, schema)
