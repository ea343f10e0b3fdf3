"""Dashboard queries: SQL with bound parameters over the marts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tonflow.functions import numbers


def funnel_view(funnel_rows: DataFrame, date_from: str, date_to: str) -> DataFrame:
    """Stage totals over a range of production days."""
    return funnel_rows.sparkSession.sql(
        """
        SELECT stage_seq, stage_code, stage_name, stage_branch, source_system,
               round(sum(tonnage_ton), 1) AS tonnage_ton, sum(trips) AS trips,
               round(avg(pct_of_baseline), 1) AS pct_of_hauling
        FROM {funnel}
        WHERE production_date BETWEEN CAST(:first AS DATE) AND CAST(:last AS DATE)
        GROUP BY ALL
        ORDER BY stage_seq, source_system
        """,
        args={"first": date_from, "last": date_to},
        funnel=funnel_rows,
    )


def loss_view(gaps: DataFrame, date_from: str, date_to: str) -> DataFrame:
    """Gaps between stages, newest day and largest loss first."""
    return gaps.sparkSession.sql(
        """
        SELECT production_date, pair_label, gap_type, upstream_ton, downstream_ton,
               delta_ton, loss_pct, recovery_pct, severity
        FROM {gaps}
        WHERE production_date BETWEEN CAST(:first AS DATE) AND CAST(:last AS DATE)
        ORDER BY production_date DESC, abs(loss_pct) DESC NULLS LAST, pair_label
        """,
        args={"first": date_from, "last": date_to},
        gaps=gaps,
    )


def trend_view(series: DataFrame, grain: str) -> DataFrame:
    return series.sparkSession.sql(
        """
        SELECT grain, period_label, period_start, actual_ton, target_ton, variance_ton,
               achievement_pct, ma7_actual_ton, status
        FROM {series} WHERE grain = :grain ORDER BY period_start
        """,
        args={"grain": grain},
        series=series,
    )


def contractor_view(contractors: DataFrame, day: str) -> DataFrame:
    return contractors.sparkSession.sql(
        """
        SELECT production_date, shift, contractor_name, netto_ton, trips, active_trucks,
               trips_per_truck, fleet_avg_trips_per_truck, productivity_gap_pct,
               avg_payload_ton, share_pct, avg_loss_pct, balancing_flag
        FROM {rows} WHERE production_date = CAST(:day AS DATE)
        ORDER BY netto_ton DESC, contractor_name, shift
        """,
        args={"day": day},
        rows=contractors,
    )


def stock_view(balance: DataFrame, date_from: str, date_to: str) -> DataFrame:
    return balance.sparkSession.sql(
        """
        SELECT hour_start_utc, in_ton, out_ton, net_ton, balance_ton, days_of_cover, buffer_status
        FROM {balance}
        WHERE production_date BETWEEN CAST(:first AS DATE) AND CAST(:last AS DATE)
        ORDER BY hour_start_utc
        """,
        args={"first": date_from, "last": date_to},
        balance=balance,
    )


def latest_suggestions_view(suggestions: DataFrame) -> DataFrame:
    """Suggestions of the latest day there are any for."""
    return suggestions.sparkSession.sql(
        """
        SELECT production_date, rank, priority, category, title, recommendation, rationale,
               owner, expected_gain_ton, confidence, generated_by
        FROM {rows}
        WHERE production_date = (SELECT max(production_date) FROM {rows})
        ORDER BY rank
        """,
        rows=suggestions,
    )


def output_tiles(summary: DataFrame) -> DataFrame:
    """Headline tiles of plant output."""
    return summary.agg(
        numbers.rsum("total_tonnage_ton", 2).alias("total_tonnage_ton"),
        numbers.ravg("avg_throughput_tph", 2).alias("avg_throughput_tph"),
        numbers.ravg("running_pct", 2).alias("running_pct"),
        numbers.ravg("productivity_tph", 2).alias("productivity_tph"),
    )


def rollup(df: DataFrame, keys: list[str], sums: list[str] = (), means: list[str] = ()) -> DataFrame:
    """Sums and averages of fields by fields: the shape of every chart widget."""
    return df.groupBy(*keys).agg(
        *[numbers.rsum(c, 4).alias(f"sum_{c}") for c in sums],
        *[numbers.ravg(c, 4).alias(f"avg_{c}") for c in means],
    )


def filter_counts(df: DataFrame, field: str, selected) -> DataFrame:
    """Values of a filter field with how many of their rows the other filters let through."""
    return df.groupBy(field).agg(F.count_if(selected).alias("associated_rows"))
