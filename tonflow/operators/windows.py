"""Windows over grouped results: ranks, shares, averages, robust scores.

These run on tables that are already aggregated to a day (or finer business) grain, where
a partition has as many rows as there are trucks, plants or days.  For raw rows in order
see :mod:`tonflow.operators.ordered`.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tonflow.functions.numbers import col, percent, steady
from tonflow.operators.ordered import quantiles
from tonflow.settings import DEFAULTS


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of every key under a total order.

    Filtering a rank lets Spark cut each group down before the shuffle, so a key that
    holds much of the table costs no more than any other.
    """
    return top_per_key(df, keys, order, 1)


def top_per_key(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int, rank: str | None = None
) -> DataFrame:
    """The first ``n`` rows of every key; ``rank`` names a column to keep the position in."""
    position = F.row_number().over(W.partitionBy(*keys).orderBy(*order))
    top = df.withColumn(rank or "_rank", position).where(F.col(rank or "_rank") <= n)
    return top if rank else top.drop("_rank")


def ranked(df: DataFrame, keys: Sequence[str], order: Sequence[Column], name: str) -> DataFrame:
    return df.withColumn(name, F.row_number().over(W.partitionBy(*keys).orderBy(*order)))


def share_of(
    df: DataFrame, value: str, keys: Sequence[str], total: str, share: str, digits: int = 2
) -> DataFrame:
    """Group total beside every row, and the row's share of it in percent."""
    whole = F.sum(value).over(W.partitionBy(*keys))
    return df.withColumn(total, steady(whole, 6)).withColumn(share, percent(value, total, digits))


def share_of_total(df: DataFrame, value: str, total: str, share: str, digits: int = 2) -> DataFrame:
    """Total of all rows beside every row, and the row's share of it in percent.

    The total is a scalar subquery: no window that would gather all rows in one task.
    """
    whole = df.agg(F.sum(value)).scalar()
    return df.withColumn(total, steady(whole, 6)).withColumn(share, percent(value, total, digits))


def moving_average(
    df: DataFrame,
    value: str,
    order: str,
    rows: int,
    name: str,
    keys: Sequence[str] = (),
    digits: int = 3,
) -> DataFrame:
    """Average over the current and the ``rows - 1`` preceding rows of a daily series."""
    # A series without keys is one partition; it has one row per day.
    frame = W.partitionBy(*(keys or [F.lit(0)])).orderBy(order).rowsBetween(1 - rows, 0)
    return df.withColumn(name, steady(F.avg(value).over(frame), digits))


def to_date_sum(
    df: DataFrame, value: str, order: str, keys: Sequence[str], name: str, digits: int = 3
) -> DataFrame:
    """Running sum within each period (month to date)."""
    frame = W.partitionBy(*keys).orderBy(order).rowsBetween(W.unboundedPreceding, 0)
    return df.withColumn(name, steady(F.sum(value).over(frame), digits))


def robust_z(
    df: DataFrame, value: str, keys: Sequence[str], constant: float = DEFAULTS.mad_constant
) -> DataFrame:
    """Median, median absolute deviation and robust z-score of a value within its group.

    Medians are exact at every size (the lower one of two in the middle) and joined back by key, so
    a long series is never held in one task.  A group without spread scores 0.
    """
    keys = list(keys)
    centred = beside(df, quantiles(df, keys, value, [0.5], ["median"]), keys)
    away = centred.withColumn("_away", F.abs(F.col(value) - F.col("median")))
    scored = beside(centred, quantiles(away, keys, "_away", [0.5], ["mad"]), keys)
    z = constant * (F.col(value) - F.col("median")) / F.col("mad")
    return scored.withColumn(
        "robust_z", steady(F.when(F.col("mad") > 0, z).otherwise(F.lit(0.0)), 2)
    )


def beside(df: DataFrame, per_key: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Left join on keys in which NULL equals NULL; keys appear once."""
    right = per_key.select(
        *[F.col(k).alias(f"_r_{k}") for k in keys],
        *[c for c in per_key.columns if c not in keys],
    )
    on = F.lit(True)
    for k in keys:
        on = on & F.col(k).eqNullSafe(F.col(f"_r_{k}"))
    return df.join(right, on, "left").drop(*[f"_r_{k}" for k in keys])


def deviation_from_mean(
    df: DataFrame, value: str, keys: Sequence[str], mean: str, deviation: str, digits: int = 3
) -> DataFrame:
    """Unweighted group mean beside every row, and the row's deviation from it in percent."""
    centre = steady(F.avg(value).over(W.partitionBy(*keys)), digits)
    gap = F.try_divide(col(value) - F.col(mean), F.col(mean)) * 100.0
    return df.withColumn(mean, centre).withColumn(deviation, steady(gap, 2))
