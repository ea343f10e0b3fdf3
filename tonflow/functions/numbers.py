"""Numbers: tolerant parsing, units, percentages and reproducible rounding."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tonflow.settings import DEFAULTS


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def steady(c: Column | str, digits: int) -> Column:
    """Round half up, giving the same answer whatever order the inputs were summed in.

    Double sums differ in their last bits from run to run because shuffle order does.
    A value that is exactly half way (an average of two weights often is) would then
    round either way; the first, finer rounding removes that noise.
    """
    return F.round(F.round(col(c), digits + 6), digits)


def to_double(c: Column | str) -> Column:
    """Number from text, thousands commas allowed; NULL when it is not a number."""
    return F.regexp_replace(col(c).cast("string"), ",", "").try_cast("double")


def to_long(c: Column | str) -> Column:
    """Whole number from text, thousands commas allowed; never goes through a double."""
    return F.regexp_replace(col(c).cast("string"), ",", "").try_cast("long")


def number_or_zero(c: Column | str) -> Column:
    return F.coalesce(col(c).cast("string").try_cast("double"), F.lit(0.0))


def kg_to_ton(c: Column | str, kg_per_ton: float = DEFAULTS.kg_per_ton) -> Column:
    return F.round(col(c).cast("string").try_cast("double") / kg_per_ton, 3)


def volume_to_ton(c: Column | str, digits: int, density: float = DEFAULTS.density) -> Column:
    return F.round(col(c) * density, digits)


def per_hour(amount: Column | str, seconds: Column | str, digits: int = 2) -> Column:
    """Hourly rate; NULL unless some time has passed."""
    return F.when(col(seconds) > 0, steady(col(amount) / (col(seconds) / 3600.0), digits))


def percent(part: Column | str, whole: Column | str, digits: int = 2) -> Column:
    """``part / whole * 100``; NULL unless ``whole`` is positive."""
    whole = col(whole)
    return steady(F.when(whole > 0, col(part) / whole * 100.0), digits)


def percent_change(value: Column | str, base: Column | str, digits: int = 2) -> Column:
    """Relative difference from ``base`` in percent; NULL when ``base`` is zero."""
    value, base = col(value), col(base)
    return steady(F.try_divide(value - base, base) * 100.0, digits)


def ratio(part: Column | str, whole: Column | str, digits: int) -> Column:
    """Quotient; NULL when ``whole`` is zero or missing."""
    return steady(F.try_divide(col(part), col(whole)), digits)


def count_true(flag: Column | str) -> Column:
    return F.sum(col(flag).cast("int"))


def rate_of(flag: Column | str, digits: int = 1) -> Column:
    """Share of rows for which a boolean holds, in percent (NULL rows left out)."""
    return steady(F.avg(col(flag).cast("int")) * 100, digits)


def rsum(c: Column | str, digits: int = 3) -> Column:
    return steady(F.sum(col(c)), digits)


def ravg(c: Column | str, digits: int = 3) -> Column:
    return steady(F.avg(col(c)), digits)
