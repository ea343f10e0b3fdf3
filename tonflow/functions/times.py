"""Time: parsing, zones, production days, shifts, labels and durations.

The session time zone is expected to be UTC (see :func:`tonflow.sources.session_defaults`).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tonflow.functions.numbers import col, steady
from tonflow.settings import DEFAULTS, Settings

# --- Fixed values -----------------------------------------------------------------
# Layouts beyond Spark's own default parser, each with the shape of text it can match.  "H"
# also takes two digits; brackets are optional parts.
SLASH_SHORT_YEAR = (r"^\d+/\d+/\d{2} ", "M/d/yy H:mm[:ss]")
SLASH_LONG_YEAR = (r"^\d+/\d+/\d{4} ", "M/d/yyyy H:mm[:ss]")
DASHED = (r"^\d{4}-\d{2}-\d{2} ", "yyyy-MM-dd HH:mm:ss[.SSSSSS][XXX][X]")
ISO_LAYOUTS = ("yyyy-MM-dd'T'HH:mm:ss[.SSS]", "yyyy-MM-dd HH:mm:ss[.SSS]")
DAY_NAMES = ("Minggu", "Senin", "Selasa", "Rabu", "Kamis", "Jumat", "Sabtu")
QUARTER_DAYS = ("00:00-05:59", "06:00-11:59", "12:00-17:59", "18:00-23:59")
# --- end of fixed values ------------------------------------------------------------


def parse_any(c: Column | str) -> Column:
    r"""Timestamp from text in any known layout; empty, ``\N`` and garbage give NULL.

    A failed attempt costs an exception inside the JVM, so a layout is only tried on text
    of its shape.
    """
    raw = F.trim(col(c).cast("string"))

    def attempt(layout: tuple[str, str]) -> Column:
        shape, pattern = layout
        return F.when(raw.rlike(shape), F.try_to_timestamp(raw, F.lit(pattern)))

    slashed = F.coalesce(attempt(SLASH_SHORT_YEAR), attempt(SLASH_LONG_YEAR))
    dashed = F.coalesce(raw.try_cast("timestamp"), attempt(DASHED))
    return F.when(raw.contains("/"), slashed).otherwise(dashed)


def parse_iso(c: Column | str) -> Column:
    """Timestamp that is already typed or is ISO text with a trailing ``Z``."""
    c = col(c)
    bare = F.regexp_replace(c.cast("string"), "Z$", "")
    attempts = [c.cast("string").try_cast("timestamp")]
    attempts += [F.try_to_timestamp(bare, F.lit(layout)) for layout in ISO_LAYOUTS]
    return F.coalesce(*attempts)


def epoch_seconds(c: Column | str) -> Column:
    return F.unix_seconds(col(c).cast("timestamp"))


def seconds_between(end: Column | str, start: Column | str) -> Column:
    """Whole seconds, each side truncated to the second first."""
    return epoch_seconds(end) - epoch_seconds(start)


def exact_minutes_between(end: Column | str, start: Column | str) -> Column:
    """Minutes with the fraction kept down to the microsecond."""
    micros = F.unix_micros(col(end).cast("timestamp")) - F.unix_micros(col(start).cast("timestamp"))
    return micros / 60_000_000.0


def elapsed_minutes(end: Column | str, start: Column | str) -> Column:
    """Minutes from start to end; NULL when negative or when either side is missing."""
    return F.when(col(end) >= col(start), seconds_between(end, start) / 60.0)


def signed_minutes(end: Column | str, start: Column | str, digits: int = 1) -> Column:
    return steady(seconds_between(end, start) / 60.0, digits)


def to_local(c: Column | str, timezone: str = DEFAULTS.timezone) -> Column:
    return F.from_utc_timestamp(col(c), timezone)


def to_utc(c: Column | str, timezone: str = DEFAULTS.timezone) -> Column:
    return F.to_utc_timestamp(col(c), timezone)


def hours_back(c: Column | str, hours: int) -> Column:
    return col(c) - F.make_dt_interval(hours=F.lit(hours))


def production_date(local: Column | str, day_start_hour: int = DEFAULTS.day_start_hour) -> Column:
    """Date of the production day; hours before its start belong to the day before."""
    return F.to_date(hours_back(local, day_start_hour))


def shift_label(
    local: Column | str,
    day: str = DEFAULTS.day_shift,
    night: str = DEFAULTS.night_shift,
    start: int = DEFAULTS.day_start_hour,
    length: int = DEFAULTS.shift_hours,
    missing: str | None = "night",
) -> Column:
    """Day or night shift of a local time.

    A missing time counts as night, as pandas- and CASE-based shift logic usually has it;
    ``missing=None`` gives NULL instead.
    """
    hour = F.hour(col(local))
    in_day = (hour >= start) & (hour < start + length)
    label = F.when(in_day, day).otherwise(night)
    return label if missing == "night" else F.when(hour.isNotNull(), label)


def shifted_hour(local: Column | str, hours: int = DEFAULTS.day_start_hour) -> Column:
    return F.hour(hours_back(local, hours))


def shifted_hour_start(local: Column | str, hours: int = DEFAULTS.day_start_hour) -> Column:
    return F.date_trunc("hour", hours_back(local, hours))


def month_key(c: Column | str) -> Column:
    return F.date_format(col(c), "yyyy-MM")


def week_start(c: Column | str) -> Column:
    return F.date_trunc("week", col(c)).cast("date")


def days_in_month(c: Column | str) -> Column:
    return F.dayofmonth(F.last_day(col(c)))


def month_first_day(month: Column | str) -> Column:
    return F.to_date(F.concat(col(month), F.lit("-01")))


def week_period_label(first_day: Column | str) -> Column:
    """``W<week>-<year>`` for the week that starts on the given day."""
    d = col(first_day)
    return F.concat(
        F.lit("W"), F.weekofyear(d).cast("string"), F.lit("-"), F.year(d).cast("string")
    )


def week_label(c: Column | str, iso_year: bool = False) -> Column:
    """``YYYY-Www``.

    By default the calendar year goes with the ISO week (30 December 2024 is
    ``2024-W01``), which existing dashboards filter on.  ``iso_year=True`` uses the year
    the ISO week belongs to.
    """
    c = col(c)
    # The Thursday of a week decides which year the ISO week belongs to.
    year = F.year(F.date_add(F.date_trunc("week", c).cast("date"), 3)) if iso_year else F.year(c)
    week = F.lpad(F.weekofyear(c).cast("string"), 2, "0")
    return F.concat(year.cast("string"), F.lit("-W"), week)


def quarter_day(c: Column | str, missing: str | None = QUARTER_DAYS[3]) -> Column:
    """Six-hour bucket label; ``missing`` is the label for a NULL time."""
    labels = F.array(*[F.lit(x) for x in QUARTER_DAYS])
    slot = F.get(labels, F.floor(F.hour(col(c)) / 6).cast("int"))
    return F.coalesce(slot, F.lit(missing)) if missing is not None else slot


def day_name(c: Column | str, missing: str | None = DAY_NAMES[6]) -> Column:
    """Indonesian weekday; ``missing`` is the label for a NULL time."""
    names = F.array(*[F.lit(x) for x in DAY_NAMES])
    name = F.get(names, F.dayofweek(col(c)) - 1)
    return F.coalesce(name, F.lit(missing)) if missing is not None else name


def with_calendar(df: DataFrame, utc: str, settings: Settings = DEFAULTS) -> DataFrame:
    """Local time, production day, shift, week and month for one UTC column.

    Week and month follow the production day, so each production day belongs to exactly
    one of each even though it runs past midnight.
    """
    local = to_local(utc, settings.timezone)
    day = production_date("ts_local", settings.day_start_hour)
    return (
        df.withColumn("ts_local", local)
        .withColumns(
            {
                "date_local": F.to_date("ts_local"),
                "hour_local": F.hour("ts_local"),
                "production_date": day,
                "shift": shift_label(
                    "ts_local",
                    settings.day_shift,
                    settings.night_shift,
                    settings.day_start_hour,
                    settings.shift_hours,
                ),
            }
        )
        .withColumns(
            {"week_start": week_start("production_date"), "month": month_key("production_date")}
        )
    )


def date_range(spark, first: str, last: str, name: str = "day") -> DataFrame:
    """One row per calendar day, both ends included."""
    days = F.sequence(F.lit(first).cast("date"), F.lit(last).cast("date"))
    return spark.range(1).select(F.explode(days).alias(name))
