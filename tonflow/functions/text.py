"""Text: missing-value markers, booleans, id lists, JSON found in prose."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tonflow.functions.numbers import col

# --- Fixed values -----------------------------------------------------------------
DUMP_MARKER = "\\N"
MISSING_MARKERS = ("\\N", "\\\\N", "null", "NULL", "NaN", "", "None")
TRUE_WORDS = ("true", "t", "1", "yes", "y")
FALSE_WORDS = ("false", "f", "0", "no", "n")

SUGGESTION_SCHEMA = T.ArrayType(
    T.StructType()
    .add("rank", T.IntegerType())
    .add("candidate_code", T.StringType())
    .add("category", T.StringType())
    .add("title", T.StringType())
    .add("recommendation", T.StringType())
    .add("rationale", T.StringType())
    .add("owner", T.StringType())
    .add("expected_gain_ton", T.DoubleType())
    .add("priority", T.StringType())
    .add("confidence", T.DoubleType())
)
# --- end of fixed values ------------------------------------------------------------


def has_column(df: DataFrame, name: str) -> bool:
    return name in df.columns


def column_or_null(df: DataFrame, name: str, dtype: str = "string") -> Column:
    """The column when the table has it, else a typed NULL."""
    return F.col(name) if name in df.columns else F.lit(None).cast(dtype)


def present(c: Column | str) -> Column:
    """Trimmed text, or NULL when it is one of the missing-value markers."""
    trimmed = F.trim(col(c).cast("string"))
    return F.when(~trimmed.isin(*MISSING_MARKERS), trimmed)


def blank_markers(df: DataFrame, columns: Iterable[str] | None = None) -> DataFrame:
    """Apply :func:`present` to the given columns (default: all) in one projection."""
    wanted = set(df.columns if columns is None else columns)
    return df.select(*[present(c).alias(c) if c in wanted else F.col(c) for c in df.columns])


def blank_dump_markers(df: DataFrame) -> DataFrame:
    r"""Turn the literal ``\N`` into NULL in every column, leaving other values untouched."""
    def kept(name: str) -> Column:
        marked = F.trim(F.col(name).cast("string")).eqNullSafe(F.lit(DUMP_MARKER))
        return F.when(~marked, F.col(name)).alias(name)

    return df.select(*map(kept, df.columns))


def to_boolean(c: Column | str) -> Column:
    word = F.lower(F.trim(col(c).cast("string")))
    return F.when(word.isin(*TRUE_WORDS), True).when(word.isin(*FALSE_WORDS), False)


def is_true_text(c: Column | str) -> Column:
    """True only for the exact text ``true``; NULL and anything else are False."""
    return F.coalesce(col(c) == "true", F.lit(False))


def code_parts(c: Column | str, names: Iterable[str], prefix: str = "") -> list[Column]:
    """Parts of a dotted code by position; missing parts are NULL, not an error."""
    parts = F.split(col(c), r"\.")
    return [F.get(parts, F.lit(i)).alias(prefix + n) for i, n in enumerate(names)]


def id_list(c: Column | str) -> Column:
    """``"[1, 2]"`` as an array of longs; entries that are not plain digits are left out."""
    bare = F.regexp_replace(F.coalesce(col(c), F.lit("")), r"[\[\]]", "")
    entries = F.transform(F.split(bare, ","), lambda e: F.trim(e))
    digits = F.filter(entries, lambda e: e.rlike("^[0-9]+$"))
    return F.transform(digits, lambda e: e.try_cast("long"))


def group_prefix(c: Column | str, width: int = 4) -> Column:
    return F.trim(F.substring(F.trim(col(c)), 1, width))


def json_array_in(c: Column | str, schema: T.ArrayType = SUGGESTION_SCHEMA) -> Column:
    """First JSON array of objects inside free text (code fences allowed), parsed."""
    found = F.regexp_extract(col(c), r"(?s)\[\s*\{.*\}\s*\]", 0)
    return F.from_json(F.when(found != "", found), schema)
