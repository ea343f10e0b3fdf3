"""tonflow: Spark-native operators for haulage and bulk-material analytics.

Everything here is a function from DataFrames to DataFrames (or from Columns to
Columns).  Catalyst plans the work, executors do it; nothing in the library pulls
rows to the driver except where a docstring says which bounded summary it reads.
"""

from tonflow.settings import DEFAULTS, Settings

__all__ = ["DEFAULTS", "Settings"]
