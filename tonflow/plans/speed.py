"""Closing transactions: speed bands, compliance and the daily speed trend."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tonflow.functions import codes, numbers
from tonflow.operators.quality import expect_or_drop
from tonflow.operators.windows import share_of

# --- Fixed values -----------------------------------------------------------------
SLOW_LIMIT, FAST_LIMIT = 7, 10
NO_SPEED = "Undefined"
SLOW = "Kurang dari 7 Kpj"
SAFE = "Antara 7 Kpj sampai 10 Kpj"
FAST = "Lebih dari 10 Kpj"
ACTUAL = "ACTUAL"
DROP_RULES = {"valid_speed": "average_speed IS NULL OR average_speed >= 0", "valid_code": "code IS NOT NULL"}
WATCH_RULES = {"valid_timestamps": "timestamp_in_local IS NOT NULL AND timestamp_out_local IS NOT NULL"}
# --- end of fixed values ------------------------------------------------------------


def speed_band(speed: Column | str) -> Column:
    v = numbers.col(speed)
    return codes.cases(
        [(v.isNull(), NO_SPEED), (v < SLOW_LIMIT, SLOW), (v <= FAST_LIMIT, SAFE)], FAST
    )


def closing_silver(bronze: DataFrame) -> DataFrame:
    """Typed times, time parts, speed band and compliance; invalid rows dropped.

    Stateless, so it serves batch and streaming frames alike.
    """
    rows = expect_or_drop(bronze, **DROP_RULES)
    came = F.col("timestamp_in")

    def parsed(c: str) -> Column:
        return F.col(c).cast("string").try_cast("timestamp")

    return rows.withColumns(
        {
            "timestamp_in": parsed("timestamp_in_local"),
            "timestamp_out": parsed("timestamp_out_local"),
            "timestamp_gross": parsed("timestamp_gross_local"),
        }
    ).withColumns(
        {
            "date": F.to_date(came),
            "hour": F.hour(came),
            "day_of_week": F.dayofweek(came),
            "week_of_year": F.weekofyear(came),
            "month": F.month(came),
            "year": F.year(came),
            "operation_date": F.to_date("timestamp_out"),
            "speed_category": speed_band("average_speed"),
            "is_compliant": F.coalesce(
                F.col("average_speed").between(SLOW_LIMIT, FAST_LIMIT), F.lit(False)
            ).cast("int"),
            "company_code_standard": F.upper("code"),
            "silver_processed_at": F.current_timestamp(),
        }
    )


def daily_speed_trend(silver: DataFrame) -> DataFrame:
    """Actual transactions with a speed, counted per day and band."""
    return (
        silver.where((F.col("status_trx_wim") == ACTUAL) & F.col("average_speed").isNotNull())
        .groupBy(
            F.date_format("timestamp_in", "yyyy-MM-dd").alias("tanggal"),
            F.col("speed_category").alias("kecepatan"),
        )
        .agg(F.count("truck").alias("jumlah_transaksi"))
    )


def speed_trend_share(trend: DataFrame, first: str | None = None, last: str | None = None) -> DataFrame:
    """Each band's share of its day; the default range is the whole trend, NULL days out."""
    day = F.col("tanggal")
    within = day.isNotNull()
    if first is not None:
        within = within & (day >= first)
    if last is not None:
        within = within & (day <= last)
    return share_of(
        trend.where(within), "jumlah_transaksi", ["tanggal"], "total_harian", "percentage_of_day", 6
    ).withColumn("total_harian", F.col("total_harian").cast("long")).orderBy(
        "tanggal", F.desc("percentage_of_day"), "kecepatan"
    )
