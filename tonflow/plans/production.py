"""Production against target by day, week and month, and the month-end outlook."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tonflow.functions import codes, numbers, times
from tonflow.operators.windows import moving_average, to_date_sum
from tonflow.settings import DEFAULTS, Settings

STATUS_BANDS = ((100, "ON_TARGET"), (90, "AT_RISK"))


def month_target(month: Column | str, settings: Settings = DEFAULTS) -> Column:
    return codes.lookup(month, settings.month_targets, settings.month_target_ton)


def daily_production(hauling: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """Weighed tonnage per production day with the day's share of the month target."""
    daily = hauling.groupBy("production_date", "month", "week_start").agg(
        numbers.rsum("netto_ton").alias("actual_ton"),
        F.count(F.lit(1)).alias("trips"),
        F.count_distinct("truck").alias("active_trucks"),
        F.count_distinct("contractor_code").alias("active_contractors"),
        numbers.ravg("netto_ton").alias("avg_payload_ton"),
    )
    target = month_target("month", settings)
    return daily.withColumns(
        {
            "month_target_ton": target,
            "target_ton": numbers.steady(target / times.days_in_month("production_date"), 3),
        }
    )


def _coarser(daily: DataFrame, key: str, target: Column) -> DataFrame:
    """Sums of tons and trips, averages of the daily counts, per coarser period."""
    return daily.groupBy(key).agg(
        numbers.rsum("actual_ton").alias("actual_ton"),
        target.alias("target_ton"),
        F.sum("trips").alias("trips"),
        numbers.ravg("active_trucks", 1).alias("active_trucks"),
        numbers.ravg("active_contractors", 1).alias("active_contractors"),
        numbers.ravg("avg_payload_ton").alias("avg_payload_ton"),
    )


def production_series(daily: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """Daily, weekly and monthly rows in one table, with variance, status and trend.

    The grains average differently, so this is three aggregates and not grouping sets; the
    coarser two read the daily table, never the trips.
    """
    measures = [
        "actual_ton", "target_ton", "trips", "active_trucks", "active_contractors", "avg_payload_ton",
    ]

    def rows(df: DataFrame, grain: str, start: Column, end: Column, label: Column) -> DataFrame:
        return df.select(
            F.lit(grain).alias("grain"),
            start.alias("period_start"),
            end.alias("period_end"),
            label.alias("period_label"),
            *[F.col(m).cast("double" if m.startswith("active") else df.schema[m].dataType).alias(m) for m in measures],
        )

    day, week = F.col("production_date"), F.col("week_start")
    first = times.month_first_day("month")
    weekly = _coarser(daily, "week_start", numbers.rsum("target_ton"))
    monthly = _coarser(daily, "month", F.round(F.max("month_target_ton"), 3))
    series = (
        rows(daily, "DAILY", day, day, F.date_format(day, "yyyy-MM-dd"))
        .unionByName(
            rows(weekly, "WEEKLY", week, F.date_add(week, 6), times.week_period_label(week))
        )
        .unionByName(rows(monthly, "MONTHLY", first, F.last_day(first), F.col("month")))
    )
    achieved = series.withColumns(
        {
            "variance_ton": F.round(F.col("actual_ton") - F.col("target_ton"), 3),
            "achievement_pct": numbers.percent("actual_ton", "target_ton"),
        }
    ).withColumn("status", codes.bands("achievement_pct", STATUS_BANDS, "BEHIND"))
    trend = moving_average(achieved, "actual_ton", "period_start", 7, "ma7_actual_ton", ["grain"])
    return trend.withColumn("ma7_actual_ton", F.when(F.col("grain") == "DAILY", F.col("ma7_actual_ton")))


def shipment_outlook(daily: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """Where each month will end at the run rate of the last seven days."""
    base = daily.select("production_date", "actual_ton").withColumn(
        "month", times.month_key("production_date")
    )
    base = moving_average(base, "actual_ton", "production_date", 7, "run_rate_7d")
    base = to_date_sum(base, "actual_ton", "production_date", ["month"], "mtd_actual_ton")
    latest = daily.agg(F.max("production_date")).scalar()
    left = F.col("days_remaining")
    gap = F.col("month_target_ton") - F.col("mtd_actual_ton")
    short = F.col("shortfall_ton")
    return (
        base.withColumns(
            {
                "days_in_month": times.days_in_month("production_date"),
                "day_of_month": F.dayofmonth("production_date"),
                "month_target_ton": month_target("month", settings),
            }
        )
        .withColumn("days_remaining", F.col("days_in_month") - F.col("day_of_month"))
        .withColumn(
            "projected_month_ton",
            numbers.steady(F.col("mtd_actual_ton") + F.col("run_rate_7d") * left, 3),
        )
        .withColumn(
            "shortfall_ton", F.round(F.col("month_target_ton") - F.col("projected_month_ton"), 3)
        )
        .withColumns(
            {
                "shortfall_pct": numbers.percent("shortfall_ton", "month_target_ton"),
                "required_rate_ton_per_day": numbers.steady(F.when(left > 0, gap / left), 3),
            }
        )
        .withColumns(
            {
                "rate_gap_ton_per_day": F.round(
                    F.col("required_rate_ton_per_day") - F.col("run_rate_7d"), 3
                ),
                "outlook_status": codes.cases(
                    [(short <= 0, "ON_TRACK"), (F.col("shortfall_pct") <= 5, "AT_RISK")], "SHORTFALL"
                ),
                "is_latest": F.col("production_date") == latest,
            }
        )
    )
