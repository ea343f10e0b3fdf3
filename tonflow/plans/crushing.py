"""Crushing plants: totaliser readings, running hours, output, density, belt checks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tonflow.functions import codes, numbers, times
from tonflow.operators.ordered import counter_delta, quantiles
from tonflow.operators.windows import beside, first_per_key, share_of_total
from tonflow.settings import DEFAULTS, Settings

# --- Fixed values -----------------------------------------------------------------
TOTALISERS = {
    "totalizer_today": "tonnage_total_today",
    "totalizer_this_month": "tonnage_total_this_month",
    "totalizer_last_month": "tonnage_total_last_month",
    "totalizer_total_month": "tonnage_total_all",
}
# --- end of fixed values ------------------------------------------------------------


def with_shift_date(df: DataFrame, ts: str, settings: Settings = DEFAULTS) -> DataFrame:
    """Shift, calendar date, and the date a night shift began on."""
    return df.withColumns(
        {
            "shift": times.shift_label(
                ts, settings.day_shift, settings.night_shift, settings.day_start_hour, settings.shift_hours
            ),
            "event_date": F.to_date(ts),
            "adjusted_date": times.production_date(ts, settings.day_start_hour),
        }
    )


def tonnage_silver(logs: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """Readings with growth, tonnage, throughput, flow mode, plant and shift.

    Of several readings of one place and time the latest received stays.
    """
    typed = logs.withColumns(
        {"timestamp_data_ts": F.col("timestamp_data").cast("timestamp"),
         "created_at_ts": F.col("created_at").cast("timestamp")}
        | {c: F.col(c).try_cast("double") for c in TOTALISERS}
    )
    latest = first_per_key(
        typed,
        ["location", "timestamp_data_ts"],
        [F.desc_nulls_last("created_at_ts"), *[F.desc_nulls_last(c) for c in TOTALISERS]],
    )
    place = F.col("location")
    is_plant, is_belt = place.startswith("CP"), place.startswith("CV")
    belt_plant = {belt: plant for plant, belt in settings.plant_belts.items()}
    readings = counter_delta(latest, ["location"], "timestamp_data_ts", "totalizer_today")
    readings = readings.withColumns(
        {
            "is_cp": is_plant,
            "is_cv": is_belt,
            "location_type": codes.cases([(is_plant, "Crushing Plant"), (is_belt, "Conveyor")], place),
            "location_group": codes.cases(
                [(is_plant, place), (place.isin(*settings.reclaim_belts), "NON_DIRECT_RECLAIM")],
                "DIRECT_SHIPMENT",
            ),
            "flow_mode": codes.cases(
                [
                    (place.isin(*settings.direct_belts), "direct"),
                    (place.isin(*settings.reclaim_belts), "non_direct"),
                    (is_plant, "cp_output"),
                ],
                "other",
            ),
            "linked_cp": F.when(is_plant, place).otherwise(codes.lookup(place, belt_plant)),
            "tonnage_delta": numbers.volume_to_ton("delta_volume", 4, settings.density),
        }
        | {ton: numbers.volume_to_ton(c, 2, settings.density) for c, ton in TOTALISERS.items()}
    ).withColumn("throughput_tph", numbers.per_hour("tonnage_delta", "time_delta_seconds"))
    return with_shift_date(readings, "timestamp_data_ts", settings)


def status_silver(items: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """Equipment states with plant name, category, running flag and shift."""
    name = F.col("name")
    category = codes.cases(
        [
            (name.isin(*settings.chain_feeders), "chain_feeder"),
            (name.isin(*settings.feeder_breakers), "feeder_breaker"),
            (name.rlike("(?i)crusher"), "crusher"),
            (name.rlike("(?i)conveyor"), "conveyor"),
        ],
        "other",
    )
    unmapped = F.concat(F.lit("CP"), F.col("cp_id").cast("string"))
    rows = items.distinct().withColumns(
        {
            "created_at_ts": F.col("created_at").cast("timestamp"),
            "cp_number": F.coalesce(codes.lookup("cp_id", settings.plants), unmapped),
            "equipment_category": category,
            "is_running": F.coalesce(F.col("status") == "Running", F.lit(False)),
        }
    )
    return with_shift_date(rows, "created_at_ts", settings)


def running_stats(status: DataFrame, date: str = "event_date", settings: Settings = DEFAULTS) -> DataFrame:
    """Hours run per plant, day, shift and equipment category.

    ``date`` is ``event_date`` (calendar) or ``adjusted_date`` (the day the shift began).
    """
    hours = F.col("running_readings") * settings.reading_seconds / 3600.0
    return (
        status.groupBy("cp_number", F.col(date).alias("event_date"), "shift", "equipment_category")
        .agg(
            F.count(F.lit(1)).alias("total_readings"),
            numbers.count_true("is_running").alias("running_readings"),
        )
        .withColumns(
            {
                "running_hours_est": numbers.steady(hours, 2),
                "running_pct": numbers.percent("running_readings", "total_readings"),
            }
        )
        .withColumn(
            "utilization",
            numbers.steady(F.col("running_hours_est") / float(settings.shift_hours) * 100, 2),
        )
    )


def plant_output(tonnage: DataFrame) -> DataFrame:
    """Output per plant and shift; first and last reading by time."""
    hours = times.seconds_between("last_reading", "first_reading") / 3600.0
    return (
        tonnage.where(F.col("is_cp") & F.col("tonnage_delta").isNotNull())
        .groupBy(F.col("location").alias("cp_name"), "adjusted_date", "shift")
        .agg(
            F.count(F.lit(1)).alias("reading_count"),
            numbers.rsum("delta_volume", 2).alias("total_volume"),
            numbers.rsum("tonnage_delta", 2).alias("total_tonnage"),
            numbers.ravg("delta_volume", 2).alias("avg_volume_per_reading"),
            numbers.ravg("tonnage_delta", 2).alias("avg_tonnage_per_reading"),
            F.max("tonnage_total_today").alias("totalizer_tonnage_eod"),
            numbers.ravg("throughput_tph", 2).alias("avg_throughput_tph"),
            F.min("timestamp_data_ts").alias("first_reading"),
            F.max("timestamp_data_ts").alias("last_reading"),
        )
        .withColumn("duration_hours", numbers.steady(hours, 2))
    )


def belt_output(tonnage: DataFrame) -> DataFrame:
    """Output per belt, flow mode and shift."""
    return (
        tonnage.where(F.col("is_cv") & F.col("tonnage_delta").isNotNull())
        .groupBy("location", "flow_mode", "adjusted_date", "shift")
        .agg(
            F.count(F.lit(1)).alias("reading_count"),
            numbers.rsum("tonnage_delta", 2).alias("total_tonnage"),
            numbers.ravg("throughput_tph", 2).alias("avg_throughput_tph"),
            F.max("tonnage_total_today").alias("totalizer_tonnage_eod"),
        )
    )


def flow_by_shift(tonnage: DataFrame) -> DataFrame:
    """Direct and reclaimed flow per day and shift."""
    return (
        tonnage.where(F.col("tonnage_delta").isNotNull() & F.col("flow_mode").isin("direct", "non_direct"))
        .groupBy("adjusted_date", "flow_mode", "shift")
        .agg(
            numbers.rsum("tonnage_delta", 4).alias("total_tonnage"),
            numbers.rsum("delta_volume", 4).alias("total_volume"),
            F.count(F.lit(1)).alias("reading_count"),
        )
        .orderBy("adjusted_date", "flow_mode", "shift")
    )


def flow_mode_share(tonnage: DataFrame) -> DataFrame:
    """Tonnage per flow mode and its share of the whole."""
    modes = (
        tonnage.where("tonnage_delta IS NOT NULL")
        .groupBy("flow_mode")
        .agg(numbers.rsum("tonnage_delta", 2).alias("total_tonnage"), F.count(F.lit(1)).alias("reading_count"))
        .where("total_tonnage > 0")
    )
    return share_of_total(modes, "total_tonnage", "grand_total", "share_pct")


def output_summary(output: DataFrame, running: DataFrame) -> DataFrame:
    """Plant output beside its running hours, and productivity per running hour."""
    hours = running.groupBy(
        F.col("cp_number").alias("cp_name"), F.col("event_date").alias("adjusted_date"), "shift"
    ).agg(
        numbers.ravg("running_hours_est", 2).alias("avg_running_hours"),
        numbers.ravg("running_pct", 2).alias("avg_running_pct"),
    )
    rows = output.join(hours, ["cp_name", "adjusted_date", "shift"], "left").select(
        F.col("adjusted_date").alias("date"),
        "shift", "cp_name",
        F.col("total_tonnage").alias("total_tonnage_ton"),
        "total_volume", "avg_throughput_tph",
        F.col("duration_hours").alias("reading_duration_hours"),
        F.coalesce("avg_running_hours", F.lit(0.0)).alias("running_hours"),
        F.coalesce("avg_running_pct", F.lit(0.0)).alias("running_pct"),
    )
    rate = F.when(F.col("running_hours") > 0, F.col("total_tonnage_ton") / F.col("running_hours"))
    return rows.withColumn("productivity_tph", numbers.steady(rate, 2))


def density_trend(tonnage: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """Realised against reference density per belt and day.

    Tonnage here is volume times the reference density, so the trend can only show
    rounding; ``density_actual`` of :func:`belt_ratio` is the measured one.
    """
    return (
        tonnage.where(F.col("is_cv") & F.col("tonnage_delta").isNotNull() & (F.col("delta_volume") > 0))
        .groupBy("adjusted_date", "location", "flow_mode")
        .agg(
            numbers.rsum("tonnage_delta", 2).alias("total_tonnage"),
            numbers.rsum("delta_volume", 2).alias("total_volume"),
        )
        .withColumns(
            {
                "density_realisasi": numbers.steady(
                    F.when(F.col("total_volume") > 0, F.col("total_tonnage") / F.col("total_volume")), 4
                ),
                "density_referensi": F.lit(settings.density),
            }
        )
        .withColumns(
            {
                "density_deviation": numbers.steady(F.col("density_realisasi") - settings.density, 4),
                "density_deviation_pct": numbers.percent_change("density_realisasi", "density_referensi"),
            }
        )
    )


def belt_ratio(weighings: DataFrame, tonnage: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """Weighbridge against belt tonnage per day, with the kind of deviation."""
    tons = F.col("netto").try_cast("double") / settings.kg_per_ton
    weighed = (
        weighings.where(F.col("netto").try_cast("double") > 0)
        .groupBy(F.to_date("timestamp_gross_local").alias("date"))
        .agg(
            numbers.rsum(tons, 2).alias("wim_tonnage"),
            F.count("id").alias("truck_count"),
            numbers.ravg(tons, 2).alias("avg_netto_per_truck"),
        )
    )
    carried = (
        tonnage.where(F.col("is_cv") & F.col("tonnage_delta").isNotNull())
        .groupBy(F.col("adjusted_date").alias("date"))
        .agg(
            numbers.rsum("tonnage_delta", 2).alias("conveyor_tonnage"),
            numbers.rsum("delta_volume", 2).alias("conveyor_volume"),
            F.count(F.lit(1)).alias("cv_reading_count"),
        )
    )
    r, slack = F.col("wim_cv_ratio"), settings.belt_tolerance
    return (
        weighed.join(carried, "date")
        .withColumn("wim_cv_ratio", numbers.ratio("wim_tonnage", "conveyor_tonnage", 4))
        .withColumns(
            {
                "deviation_pct": numbers.steady((r - 1.0) * 100, 2),
                "anomaly_flag": F.coalesce(numbers.steady(F.abs(r - 1.0), 6) > slack, F.lit(False)),
                "anomaly_type": codes.cases(
                    [(r > 1.0 + slack, "WIM_OVER"), (r < 1.0 - slack, "CV_OVER")], "NORMAL"
                ),
                "density_actual": F.when(
                    F.col("conveyor_volume") > 0, numbers.ratio("wim_tonnage", "conveyor_volume", 4)
                ),
            }
        )
    )


def ratio_summary(ratios: DataFrame) -> DataFrame:
    return ratios.agg(
        F.min("date").alias("first_date"),
        F.max("date").alias("last_date"),
        F.count(F.lit(1)).alias("days"),
        numbers.ravg("wim_cv_ratio", 4).alias("avg_ratio"),
        F.min("wim_cv_ratio").alias("min_ratio"),
        F.max("wim_cv_ratio").alias("max_ratio"),
        F.count_if("anomaly_flag").alias("anomaly_days"),
        numbers.rate_of("anomaly_flag", 2).alias("anomaly_pct"),
    )


def box_stats(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Minimum, exact quartiles and maximum of groups with more than one value."""
    keys = list(keys)
    quarters = quantiles(df, keys, value, [0.25, 0.5, 0.75], ["q1", "median", "q3"], between=True)
    known = df.where(F.col(value).isNotNull()).groupBy(*keys)
    ends = known.agg(F.count(F.lit(1)).alias("n"), F.min(value).alias("low"), F.max(value).alias("high"))
    rows = beside(ends.where("n > 1"), quarters, keys)
    return rows.select(*keys, "n", "low", *[numbers.steady(q, 6).alias(q) for q in ("q1", "median", "q3")], "high")


def tonnage_pivot(
    output: DataFrame, row: str, column: str, values: Sequence[str], ton: str = "total_tonnage"
) -> DataFrame:
    """Tonnage by row and column value, zero where there is none."""
    wide = output.groupBy(row).pivot(column, list(values)).agg(numbers.rsum(ton, 2))
    return wide.na.fill(0.0, list(values))


def totals_by(output: DataFrame, key: str, ton: str = "total_tonnage") -> DataFrame:
    return output.groupBy(key).agg(numbers.rsum(ton, 2).alias(ton)).orderBy(F.desc(ton), key)
