"""Daily production funnel and the gaps between its stages."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tonflow.functions import codes, numbers
from tonflow.settings import DEFAULTS, Settings

BASELINE = "HAULING_WEIGHED"
SHIPMENT = "SHIPMENT"


def stage_totals(
    df: DataFrame, stage: tuple, system: str, ton: str, unit: str | None = "truck"
) -> DataFrame:
    """Tons, trips and distinct units per production day of one stage."""
    seq, code, label, branch = stage
    units = F.count_distinct(unit) if unit else F.lit(None).cast("long")
    return df.groupBy("production_date").agg(
        F.lit(seq).alias("stage_seq"),
        F.lit(code).alias("stage_code"),
        F.lit(label).alias("stage_name"),
        F.lit(branch).alias("stage_branch"),
        F.lit(system).alias("source_system"),
        numbers.rsum(ton).alias("tonnage_ton"),
        F.count(F.lit(1)).alias("trips"),
        units.alias("distinct_units"),
    )


def daily_intake(dumping: DataFrame) -> DataFrame:
    """Plant intake per day, from dumping events that carry a tonnage."""
    return dumping.where("has_tonnage").groupBy("production_date").agg(
        F.sum("tonase_ton").alias("cp_intake_ton")
    )


def funnel(
    loading: DataFrame,
    hauling: DataFrame,
    ledger: DataFrame,
    dumping: DataFrame,
    shipment: DataFrame,
    settings: Settings = DEFAULTS,
) -> DataFrame:
    """One row per production day and stage, with its share of the weighed tonnage.

    Stages measured on the same table are separate, filtered aggregates of it; each is
    reduced to days before anything is joined.
    """
    stage = {s[1]: s for s in settings.stages}
    parts = [
        stage_totals(loading.where("has_tonnage"), stage["ROM_PRODUCTION"], "URISE", "tonase_ton"),
        stage_totals(hauling, stage[BASELINE], "WIM_UCAN", "netto_ton"),
        stage_totals(
            hauling.where("flow_path = 'DIRECT_CP'"), stage["HAULING_DIRECT_CP"], "WIM_UCAN", "netto_ton"
        ),
        stage_totals(ledger.where("movement = 'IN'"), stage["STOCKPILE_IN"], "USCAVIS", "qty_ton"),
        stage_totals(ledger.where("movement = 'OUT'"), stage["STOCKPILE_OUT"], "USCAVIS", "qty_ton"),
        stage_totals(dumping.where("has_tonnage"), stage["CP_INTAKE"], "URISE", "tonase_ton"),
    ]
    seq, code, label, branch = stage[SHIPMENT]
    shipped = shipment.select(
        "production_date",
        F.lit(seq).alias("stage_seq"),
        F.lit(code).alias("stage_code"),
        F.lit(label).alias("stage_name"),
        F.lit(branch).alias("stage_branch"),
        F.col("shipment_source").alias("source_system"),
        F.round("shipment_ton", 3).alias("tonnage_ton"),
        F.lit(None).cast("long").alias("trips"),
        F.lit(None).cast("long").alias("distinct_units"),
        "is_estimated",
    )
    measured = reduce(DataFrame.unionByName, parts).withColumn("is_estimated", F.lit(False))
    rows = measured.unionByName(shipped)
    baseline = parts[1].select("production_date", F.col("tonnage_ton").alias("baseline_ton"))
    return rows.join(baseline, "production_date", "left").withColumns(
        {
            "pct_of_baseline": numbers.percent("tonnage_ton", "baseline_ton"),
            "is_estimated": F.coalesce("is_estimated", F.lit(True)),
        }
    )


def stages_wide(funnel_rows: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """One row per day with a column per stage; the value list is fixed, so no extra job."""
    names = [s[1] for s in settings.stages]
    return funnel_rows.groupBy("production_date").pivot("stage_code", names).agg(
        F.max("tonnage_ton")
    )


def stage_gaps(funnel_rows: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """Loss and recovery between paired stages, one row per day and pair."""
    up, down = F.col("upstream_ton"), F.col("downstream_ton")

    def pair(upstream: str, downstream: str, label: str, kind: str) -> Column:
        return F.struct(
            F.lit(upstream).alias("upstream_stage"),
            F.lit(downstream).alias("downstream_stage"),
            F.lit(label).alias("pair_label"),
            F.lit(kind).alias("gap_type"),
            F.col(upstream).alias("upstream_ton"),
            F.col(downstream).alias("downstream_ton"),
        )

    pairs = F.array(*[pair(*p) for p in settings.stage_pairs])
    rows = stages_wide(funnel_rows, settings).select("production_date", F.inline(pairs))
    size = F.abs("loss_pct")
    return (
        rows.withColumn("delta_ton", F.round(up - down, 3))
        .withColumns(
            {
                "loss_pct": numbers.percent("delta_ton", "upstream_ton"),
                "recovery_pct": numbers.percent("downstream_ton", "upstream_ton"),
            }
        )
        .withColumns(
            {
                "severity": codes.cases(
                    [
                        (F.col("gap_type") == "BUFFER_CHANGE", "INFO"),
                        (size >= settings.loss_critical_pct, "CRITICAL"),
                        (size >= settings.loss_warn_pct, "WARNING"),
                        (size.isNull(), "NO_DATA"),
                    ],
                    "NORMAL",
                ),
                "direction": codes.cases(
                    [(F.col("delta_ton") > 0, "LOSS"), (F.col("delta_ton") < 0, "GAIN")], "BALANCED"
                ),
            }
        )
    )


def overflow_days(funnel_rows: DataFrame, tolerance: float = 1.05, settings: Settings = DEFAULTS) -> DataFrame:
    """Days on which the plants took in more than was hauled and reclaimed (one count)."""
    wide = stages_wide(funnel_rows, settings)
    supply = F.coalesce(F.col(BASELINE), F.lit(0.0)) + F.coalesce("STOCKPILE_OUT", F.lit(0.0))
    return wide.agg(F.count_if(F.col("CP_INTAKE") > supply * tolerance).alias("overflow_days"))
