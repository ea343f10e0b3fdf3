"""Expectations, check logs and table profiles, each in one pass over the data."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tonflow.functions.numbers import steady

BLOCKING = "BLOCKING"
WARNING = "WARNING"


# --- expectations -------------------------------------------------------------------


def expect_or_drop(df: DataFrame, **rules: Column | str) -> DataFrame:
    """Keep rows that meet every rule.  A rule that comes out NULL is not met."""
    for rule in rules.values():
        df = df.where(F.coalesce(_test(rule), F.lit(False)))
    return df


def expect(df: DataFrame, observation: Observation | str, **rules: Column | str) -> DataFrame:
    """Keep all rows and count, while they pass, how many miss each rule.

    Works on batch and streaming frames.  An :class:`Observation` hands the counts over
    after the batch action; a name makes them part of the streaming progress.
    """
    counts = [F.count(F.lit(1)).alias("rows")]
    counts += [
        F.count_if(~F.coalesce(_test(rule), F.lit(False))).alias(name)
        for name, rule in rules.items()
    ]
    return df.observe(observation, *counts)


def expectation_counts(df: DataFrame, **rules: Column | str) -> DataFrame:
    """Rows, and rows that miss each rule, as a one-row table."""
    return df.agg(
        F.count(F.lit(1)).alias("total_rows"),
        *[
            F.count_if(~F.coalesce(_test(rule), F.lit(False))).alias(name)
            for name, rule in rules.items()
        ],
    )


def _test(rule: Column | str) -> Column:
    return F.expr(rule) if isinstance(rule, str) else rule


# --- check log ----------------------------------------------------------------------


@dataclass(frozen=True)
class Check:
    """A measured value that must not pass a limit.

    ``value`` is an aggregate.  It passes when at most ``limit``, or at least ``limit``
    with ``at_least``.
    """

    name: str
    layer: str
    table: str
    level: str
    value: Column
    limit: float
    at_least: bool = False


class BlockingCheckFailed(ValueError):
    """At least one blocking check failed; the tables must not be published."""


def run_checks(df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """All checks of one table in one aggregate, as one row per check."""
    measured = df.agg(
        *[F.coalesce(c.value.cast("double"), F.lit(0.0)).alias(f"v{i}") for i, c in enumerate(checks)]
    )
    rows = []
    for i, c in enumerate(checks):
        value = F.col(f"v{i}")
        passed = value >= c.limit if c.at_least else value <= c.limit
        rows.append(
            F.struct(
                F.lit(c.name).alias("check_name"),
                F.lit(c.layer).alias("layer"),
                F.lit(c.table).alias("table_name"),
                F.lit(c.level).alias("level"),
                value.alias("value"),
                F.lit(float(c.limit)).alias("threshold"),
                passed.alias("passed"),
            )
        )
    return measured.select(F.inline(F.array(*rows)))


def check_log(*results: DataFrame) -> DataFrame:
    """Check results with the run's time, ready to append to a log table."""
    log = results[0]
    for r in results[1:]:
        log = log.unionByName(r)
    return log.withColumns({"run_ts_utc": F.current_timestamp(), "run_date": F.current_date()})


def gate(log: DataFrame) -> DataFrame:
    """Raise if a blocking check failed, else give the log back.

    Call before writing.  Reads only the failed blocking rows, of which there are at most
    as many as checks.
    """
    failed = log.where((F.col("level") == BLOCKING) & ~F.col("passed")).collect()
    if failed:
        names = ", ".join(f"{r['check_name']}={r['value']}" for r in failed)
        raise BlockingCheckFailed(f"{len(failed)} blocking check(s) failed: {names}")
    return log


def percent_of_rows(condition: Column) -> Column:
    """Percentage of rows for which a condition holds, as an aggregate."""
    n = F.count(F.lit(1))
    return steady(F.coalesce(F.try_divide(F.count_if(condition) * 100.0, n), F.lit(0.0)), 2)


def repeated_rows(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """How many rows are surplus because their key was already taken (one row).

    Two-step, so the distinct keys are never held by one task.
    """
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return per_key.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("surplus_rows"))


# --- profiles -----------------------------------------------------------------------


def null_profile(df: DataFrame) -> DataFrame:
    """Per column: rows, NULLs and their percentage, from one pass."""
    n = F.count(F.lit(1))
    once = df.agg(
        n.alias("rows"), *[F.count_if(F.col(c).isNull()).alias(f"n{i}") for i, c in enumerate(df.columns)]
    )
    rows = [
        F.struct(
            F.lit(c).alias("column_name"),
            F.col("rows").alias("total_rows"),
            F.col(f"n{i}").alias("null_count"),
            steady(F.try_divide(F.col(f"n{i}") * 100.0, F.col("rows")), 2).alias("null_pct"),
        )
        for i, c in enumerate(df.columns)
    ]
    return once.select(F.inline(F.array(*rows)))


def table_profile(df: DataFrame, name: str) -> DataFrame:
    """Rows, columns and groups of fully identical rows."""
    groups = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_n"))
    return groups.agg(
        F.lit(name).alias("table_name"),
        F.coalesce(F.sum("_n"), F.lit(0)).alias("total_rows"),
        F.lit(len(df.columns)).alias("total_columns"),
        F.count_if(F.col("_n") > 1).alias("duplicate_groups"),
    )


def inventory(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Row and column counts of several tables."""
    parts = [
        df.agg(
            F.lit(name).alias("table_name"),
            F.count(F.lit(1)).alias("total_rows"),
            F.lit(len(df.columns)).alias("total_columns"),
        )
        for name, df in tables.items()
    ]
    whole = parts[0]
    for p in parts[1:]:
        whole = whole.unionByName(p)
    return whole


def batch_history(df: DataFrame, batch: str, ingested: str, created: str) -> DataFrame:
    """What each load brought: rows and the span of their dates."""
    return (
        df.groupBy(batch)
        .agg(
            F.count(F.lit(1)).alias("row_count"),
            F.min(ingested).alias("ingested_at"),
            F.min(created).alias("min_date"),
            F.max(created).alias("max_date"),
        )
        .orderBy("ingested_at", batch)
    )


def key_uniqueness(df: DataFrame, key: str) -> DataFrame:
    return df.agg(
        F.count(F.lit(1)).alias("total_rows"), F.count_distinct(key).alias("unique_keys")
    )


def distribution(df: DataFrame, keys: Sequence[str], value: str | None = None) -> DataFrame:
    """Rows (and a total) per group with the group's share of the whole."""
    from tonflow.operators.windows import share_of_total

    aggs = [F.count(F.lit(1)).alias("total_rows")]
    if value:
        aggs.append(steady(F.sum(value), 2).alias("total_value"))
    counted = df.groupBy(*keys).agg(*aggs)
    measure = "total_value" if value else "total_rows"
    return share_of_total(counted, measure, "grand_total", "share_pct")
