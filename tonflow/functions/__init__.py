"""Column builders: plain Python functions that return Spark Columns."""

from tonflow.functions import codes, geo, numbers, text, times

__all__ = ["codes", "geo", "numbers", "text", "times"]
