"""JDBC reads with a pushed-down query and retries.

The driver, dialect and credentials come from the caller; nothing here is specific to one
database.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

FETCH_SIZE = 1000


class RetriesExhausted(RuntimeError):
    """Every attempt to read failed; the last error is the cause."""


@dataclass(frozen=True)
class JdbcSource:
    url: str
    driver: str | None = None
    properties: Mapping[str, str] = field(default_factory=dict)
    # Give all four to read over several connections at once.
    partition_column: str | None = None
    lower: str | None = None
    upper: str | None = None
    partitions: int | None = None

    def options(self, query: str) -> dict[str, str]:
        given = {"url": self.url, "dbtable": query, "fetchsize": str(FETCH_SIZE)}
        if self.driver:
            given["driver"] = self.driver
        if self.partition_column:
            given |= {
                "partitionColumn": self.partition_column,
                "lowerBound": str(self.lower),
                "upperBound": str(self.upper),
                "numPartitions": str(self.partitions),
            }
        return given | dict(self.properties)

    def read(self, spark: SparkSession, query: str) -> DataFrame:
        return spark.read.format("jdbc").options(**self.options(query)).load()


def newer_than(
    table: str,
    column: str,
    watermark: str | None,
    limit: int | None = None,
    alias: str = "increment",
) -> str:
    """Subquery for rows past a watermark, evaluated by the database.

    With ``limit`` a run takes the oldest ``limit`` rows and all that share the last one's
    value, so repeated runs walk forward and leave none behind.
    """
    past = ""
    if watermark is not None:
        literal = str(watermark).replace("'", "''")
        past = f"{column} > '{literal}'"
    conditions = [past] if past else []
    if limit is not None:
        oldest = f"SELECT {column} AS edge FROM {table}{past and ' WHERE ' + past} ORDER BY {column} LIMIT {int(limit)}"
        conditions.append(f"{column} <= (SELECT MAX(edge) FROM ({oldest}) AS oldest)")
    query = f"SELECT * FROM {table}" + (" WHERE " + " AND ".join(conditions) if conditions else "")
    return f"({query}) AS {alias}"


def read_with_retry(
    read: Callable[[], DataFrame],
    attempts: int = 3,
    wait_seconds: float = 30.0,
    backoff: float = 1.0,
    probe: Callable[[DataFrame], object] | None = None,
    sleep: Callable[[float], None] = time.sleep,
) -> DataFrame:
    """Call ``read`` until it works, waiting between attempts.

    ``backoff`` multiplies the wait after each failure (1.0 keeps it fixed).  ``probe``
    forces a first contact; the default reads one row rather than counting the whole
    source, which would read everything twice.
    """
    probe = probe or (lambda df: df.limit(1).count())
    wait = wait_seconds
    for attempt in range(1, attempts + 1):
        try:
            df = read()
            probe(df)
            return df
        except Exception as error:
            if attempt == attempts:
                raise RetriesExhausted(f"gave up after {attempts} attempts") from error
            sleep(wait)
            wait *= backoff
    raise ValueError("attempts must be at least 1")
