"""Codes: loading points, destinations, contractors and other lookups."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from tonflow.functions.numbers import col
from tonflow.settings import DEFAULTS

# --- Fixed values -----------------------------------------------------------------
UNKNOWN = "UNKNOWN"
UNRESOLVED = "UNRESOLVED"
STOCKPILE = "NORTH-STOCKPILE"
PORT = "PORT-BIB"
# Loading points: pattern on the upper-case name, code.
ROM_PATTERNS = (
    (r"^ROM\s*A\s*1", "ROM-A1"),
    (r"^ROM\s*A\s*2", "ROM-A2"),
    (r"^ROM\s*A\s*3", "ROM-A3"),
    (r"^ROM\s*B\s*1", "ROM-B1"),
    (r"^ROM\s*B\s*2", "ROM-B2"),
    (r"PIT\s*C", "PIT-C-APL"),
)
ROM_CODES_KEPT = ("ROM-A1", "ROM-A2", "ROM-A3")
PLANT_PATTERN = r"CP[\s\-_]*([0-9]+[AB]?)"
KM_PATTERN = r"KM\s+([\d.]+)"
REMARK_TRUCK_PATTERN = r"(?i)for\s+([A-Za-z]+\s*[0-9]+)"
STATUS_COLOURS = {"online": "#00FF00", "offline": "#FF0000"}
OTHER_COLOUR = "#FFFF00"
# --- end of fixed values ------------------------------------------------------------


def cases(branches, otherwise=None) -> Column:
    """CASE over (condition, value) pairs; first match wins."""
    chain = None
    for condition, value in branches:
        value = value if isinstance(value, Column) else F.lit(value)
        chain = F.when(condition, value) if chain is None else chain.when(condition, value)
    return chain if otherwise is None else chain.otherwise(otherwise)


def lookup(key: Column | str, mapping: Mapping, default=None) -> Column:
    """Dictionary lookup as a map literal; ``default`` for keys it lacks."""
    if not mapping:
        return default if isinstance(default, Column) else F.lit(default)
    pairs = [F.lit(x) for item in mapping.items() for x in item]
    found = F.try_element_at(F.create_map(*pairs), col(key))
    return found if default is None else F.coalesce(
        found, default if isinstance(default, Column) else F.lit(default)
    )


def upper_trim(c: Column | str) -> Column:
    return F.upper(F.trim(col(c).cast("string")))


def null_if_empty(c: Column) -> Column:
    return F.when(c != "", c)


def rom_code(c: Column | str) -> Column:
    name = upper_trim(c)
    branches = [(name.rlike(pattern), code) for pattern, code in ROM_PATTERNS]
    branches.append((name.isin(*ROM_CODES_KEPT), name))
    return cases(branches, UNKNOWN)


def destination_code(c: Column | str) -> Column:
    """Stockpile, ``CP-<number>``, port or UNKNOWN."""
    name = upper_trim(c)
    plant = F.regexp_extract(name, PLANT_PATTERN, 1)
    return cases(
        [
            (name.contains("STOCKPILE") | name.rlike(r"NORTH[\s\-]*STOCK"), STOCKPILE),
            (plant != "", F.concat(F.lit("CP-"), plant)),
            (name.contains("PORT"), PORT),
        ],
        UNKNOWN,
    )


def node_code(c: Column | str) -> Column:
    """Code of the place a truck visited, by the kind of place its name starts with."""
    name = F.upper(col(c).cast("string"))
    return cases(
        [
            (name.startswith("ROM"), rom_code(c)),
            (name.contains("STOCKPILE"), STOCKPILE),
            (name.startswith("CP"), destination_code(c)),
        ],
        UNRESOLVED,
    )


def node_type(code: Column | str) -> Column:
    code = col(code)
    return cases(
        [
            (code.startswith("ROM") | code.startswith("PIT"), "ROM"),
            (code == STOCKPILE, "STOCKPILE"),
            (code.startswith("CP-"), "CP"),
        ],
        UNRESOLVED,
    )


def flow_path(destination: Column | str) -> Column:
    d = col(destination)
    return cases(
        [(d == STOCKPILE, "VIA_STOCKPILE"), (d.startswith("CP-"), "DIRECT_CP"), (d == PORT, "DIRECT_PORT")],
        UNKNOWN,
    )


def truck_prefix(c: Column | str) -> Column:
    """Leading letters of a truck number, which name its contractor."""
    return F.upper(F.regexp_extract(F.trim(col(c).cast("string")), r"^([A-Za-z]+)", 1))


def contractor_name(code: Column | str, contractors: Mapping = DEFAULTS.contractors) -> Column:
    return lookup(code, contractors, UNKNOWN)


def plant_short_name(c: Column | str) -> Column:
    """``CP-2A`` as ``CP2A``, the spelling of the belt and plant readings."""
    return F.regexp_replace(upper_trim(c), r"^CP[\s\-_]*", "CP")


def km_marker(c: Column | str) -> Column:
    """``KM 3.5`` gives ``3.5``; empty text when the name has no marker."""
    return F.regexp_extract(F.coalesce(col(c), F.lit("")), KM_PATTERN, 1)


def truck_in_remark(c: Column | str) -> Column:
    found = F.regexp_extract(F.coalesce(col(c), F.lit("")), REMARK_TRUCK_PATTERN, 1)
    return null_if_empty(F.upper(F.trim(found)))


def status_colour(c: Column | str) -> Column:
    return lookup(c, STATUS_COLOURS, OTHER_COLOUR)


def bands(c: Column | str, steps, lowest: str, missing: str | None = None) -> Column:
    """Label by the first threshold (given high to low) the value reaches."""
    c = col(c)
    branches = [(c.isNull(), missing)] if missing is not None else []
    branches += [(c >= limit, label) for limit, label in steps]
    return cases(branches, lowest)
