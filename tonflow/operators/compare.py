"""Comparison of two tables: structure, cells by position, values in common."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tonflow.functions.codes import bands
from tonflow.functions.numbers import steady
from tonflow.operators.ordered import row_numbers

# --- Fixed values -----------------------------------------------------------------
STRUCTURE_WEIGHT = 0.4
ROWS_WEIGHT = 0.3
VALUES_WEIGHT = 0.3
OVERALL_BANDS = ((90, "ALMOST_IDENTICAL"), (70, "SIMILAR"), (50, "SOMEWHAT_RELATED"))
OVERALL_LOWEST = "DIFFERENT"
# --- end of fixed values ------------------------------------------------------------


def column_sets(left: DataFrame, right: DataFrame) -> tuple[list, list, list]:
    """Columns in both, only left, only right; in table order."""
    l, r = left.columns, right.columns
    return (
        [c for c in l if c in r],
        [c for c in l if c not in r],
        [c for c in r if c not in l],
    )


def _row_counts(left: DataFrame, right: DataFrame) -> DataFrame:
    """Row counts of both tables in one row."""
    n = F.count(F.lit(1))
    zero = F.lit(0).cast("long")
    counts = left.agg(n.alias("left_rows"), zero.alias("right_rows")).unionByName(
        right.agg(zero.alias("left_rows"), n.alias("right_rows"))
    )
    return counts.agg(F.sum("left_rows").alias("left_rows"), F.sum("right_rows").alias("right_rows"))


def compare_structure(left: DataFrame, right: DataFrame) -> DataFrame:
    """One row: columns shared and not, type differences, shapes, two structure scores.

    ``jaccard_pct`` is shared over all columns, ``max_pct`` shared over the wider table.
    """
    both, only_left, only_right = column_sets(left, right)
    types_l, types_r = dict(left.dtypes), dict(right.dtypes)
    differing = sorted(c for c in both if types_l[c] != types_r[c])
    union = len(both) + len(only_left) + len(only_right)
    wider = max(len(left.columns), len(right.columns))

    def names(values: Sequence[str]):
        return F.array(*[F.lit(v) for v in values]).cast("array<string>")

    return _row_counts(left, right).select(
        names(sorted(both)).alias("common_columns"),
        names(sorted(only_left)).alias("only_left"),
        names(sorted(only_right)).alias("only_right"),
        names(differing).alias("type_differences"),
        "left_rows",
        "right_rows",
        F.lit(len(left.columns)).alias("left_columns"),
        F.lit(len(right.columns)).alias("right_columns"),
        F.lit(round(len(both) / union * 100, 2) if union else 0.0).alias("jaccard_pct"),
        F.lit(round(len(both) / wider * 100, 2) if wider else 0.0).alias("max_pct"),
    )


def compare_cells(
    left: DataFrame,
    right: DataFrame,
    order: Sequence[str],
) -> DataFrame:
    """Per shared column, how many cells agree row by row (by position under ``order``).

    Positions run over the rows both tables have.  Cells are compared as text and two
    NULLs agree.
    """
    both = sorted(column_sets(left, right)[0])
    wanted = list(dict.fromkeys([*both, *order]))

    def placed(df: DataFrame, prefix: str) -> DataFrame:
        numbered = row_numbers(df.select(*wanted), order, "_pos")
        return numbered.select("_pos", *[F.col(c).cast("string").alias(prefix + c) for c in both])

    aligned = placed(left, "l_").join(placed(right, "r_"), "_pos")
    totals = aligned.agg(
        F.count(F.lit(1)).alias("n"),
        *[
            F.count_if(F.col("l_" + c).eqNullSafe(F.col("r_" + c))).alias(f"m{i}")
            for i, c in enumerate(both)
        ],
    )
    rows = [
        F.struct(
            F.lit(c).alias("column_name"),
            F.col(f"m{i}").alias("matches"),
            F.col("n").alias("total"),
            steady(F.coalesce(F.try_divide(F.col(f"m{i}") * 100.0, F.col("n")), F.lit(0.0)), 2).alias(
                "percentage"
            ),
        )
        for i, c in enumerate(both)
    ]
    return totals.select(F.inline(F.array(*rows)))


def cell_summary(per_column: DataFrame) -> DataFrame:
    """Overall agreement of :func:`compare_cells` results."""
    return per_column.agg(
        F.sum("matches").alias("total_matching_cells"),
        F.sum("total").alias("total_cells"),
        steady(
            F.coalesce(F.try_divide(F.sum("matches") * 100.0, F.sum("total")), F.lit(0.0)), 2
        ).alias("overall_similarity"),
    )


def value_overlap(left: DataFrame, right: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Per column, distinct values in both tables and in either (as text, NULLs left out)."""

    def melted(df: DataFrame, side: int) -> DataFrame:
        cells = F.array(
            *[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("v")) for c in columns]
        )
        return df.select(F.inline(cells), F.lit(side).alias("side")).where("v IS NOT NULL")

    seen = (
        melted(left, 1)
        .unionByName(melted(right, 2))
        .groupBy("column_name", "v")
        .agg(F.bit_or("side").alias("sides"))
    )
    return seen.groupBy("column_name").agg(
        F.count_if(F.col("sides") == 3).alias("common_values"),
        F.count_if(F.col("sides") == 1).alias("only_left_values"),
        F.count_if(F.col("sides") == 2).alias("only_right_values"),
        (F.count_if(F.col("sides") == 3) * 100.0 / F.count(F.lit(1))).alias("overlap_pct"),
    )


def compare_overall(left: DataFrame, right: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Weighted similarity of two tables: structure, row counts, shared values.

    Values are compared in all common columns unless the caller names some.
    """
    both, only_left, only_right = column_sets(left, right)
    union = len(both) + len(only_left) + len(only_right)
    structure = len(both) / union * 100 if union else 0.0
    columns = list(columns or both)
    sides = _row_counts(left, right)
    if columns:
        overlap = value_overlap(left, right, columns).agg(F.avg("overlap_pct"))
        sides = sides.withColumn("_overlap", F.coalesce(overlap.scalar(), F.lit(0.0)))
    else:
        sides = sides.withColumn("_overlap", F.lit(0.0))
    diff = F.abs(F.col("left_rows") - F.col("right_rows"))
    diff_pct = F.coalesce(
        F.try_divide(diff * 100.0, F.greatest("left_rows", "right_rows")), F.lit(0.0)
    )
    overall = (
        structure * STRUCTURE_WEIGHT
        + (100.0 - diff_pct) * ROWS_WEIGHT
        + F.col("_overlap") * VALUES_WEIGHT
    )
    return sides.select(
        steady(overall, 2).alias("overall_similarity"),
        steady(F.lit(structure), 2).alias("structure_similarity"),
        steady(100.0 - diff_pct, 2).alias("row_similarity"),
        steady("_overlap", 2).alias("data_overlap"),
        diff.alias("row_diff"),
        steady(diff_pct, 2).alias("row_diff_pct"),
        bands(overall, OVERALL_BANDS, OVERALL_LOWEST).alias("verdict"),
    )
