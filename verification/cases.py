"""All registered queries."""

from verification import cases_haulage, cases_plants, cases_similarity, cases_tables, cases_tracking  # noqa: F401
from verification.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
