"""What streams tell about themselves: missed expectations and late rows, batch by batch."""

from __future__ import annotations

from collections.abc import Mapping
from threading import Event

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql.streaming.listener import StreamingQueryListener
from pyspark.sql.streaming.query import StreamingQuery

from tonflow.operators.quality import expect

COUNTS = "query string, batch long, expectation string, rows long, missed long"
LATE = "query string, batch long, input_rows long, dropped long"


def watched(df: DataFrame, name: str, rules: Mapping[str, Column | str]) -> DataFrame:
    """The stream unchanged; how many rows miss each rule becomes part of its progress as ``name``."""
    return expect(df, name, **rules)


class StreamLog(StreamingQueryListener):
    """Appends, for every batch of every stream of the session, its counts to two tables of files.

    ``expectations``: per batch and observed rule the rows seen and those that miss it.  ``late``: per
    batch the rows read and those that stateful steps dropped because the watermark had passed them
    (after Spark has combined rows of a group, so exact where rows are not combined first).
    One small file a batch; a batch that is repeated after a failure is logged again and counts once
    when read through :meth:`expectations` and :meth:`late`.
    """

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark, self.folder = spark, folder
        self._ended: dict[str, Event] = {}

    def onQueryStarted(self, event) -> None:
        self._end(str(event.id))

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        query, batch = str(progress.id), progress.batchId
        counts = []
        for name, row in progress.observedMetrics.items():
            seen = row.asDict()
            counts += [(query, batch, f"{name}.{rule}", seen["rows"], n) for rule, n in seen.items() if rule != "rows"]
        self._append("expectations", counts, COUNTS)
        dropped = sum(s.numRowsDroppedByWatermark for s in progress.stateOperators)
        self._append("late", [(query, batch, progress.numInputRows, dropped)], LATE)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self._end(str(event.id)).set()

    def _end(self, query: str) -> Event:
        return self._ended.setdefault(query, Event())

    def _append(self, table: str, rows: list[tuple], schema: str) -> None:
        if rows:
            self.spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{self.folder}/{table}")

    def run(self, query: StreamingQuery, seconds: float = 600.0) -> None:
        """Wait until a stream that works off what is there has ended and all its batches are logged."""
        query.awaitTermination()
        if not self._end(str(query.id)).wait(seconds):
            raise TimeoutError(f"the end of query {query.id} was not announced")

    def forget(self) -> None:
        """A stream that is started again has the same id; its end counts anew."""
        self._ended.clear()

    def expectations(self) -> DataFrame:
        return self._read("expectations", COUNTS)

    def late(self) -> DataFrame:
        return self._read("late", LATE)

    def _read(self, table: str, schema: str) -> DataFrame:
        columns = [c.split()[0] for c in schema.split(", ")]
        try:
            rows = self.spark.read.schema(schema).parquet(f"{self.folder}/{table}")
        except Exception as missing:
            if "PATH_NOT_FOUND" not in str(missing):
                raise
            return self.spark.createDataFrame([], schema)
        keys = [c for c in columns if c in ("query", "batch", "expectation")]
        return rows.dropDuplicates(keys)
