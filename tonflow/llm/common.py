"""What several operators of this package need."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tonflow.sources.session import checkpoint_ready, code_on_workers, cut_lineage  # noqa: F401

#: A word is a longest run of characters that are none of these six.
BLANKS = r"\x20\x09-\x0D"
WORD = rf"[^{BLANKS}]+"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def stored(df: DataFrame) -> DataFrame:
    """A copy of ``df`` in the cluster's shared folder, read back; fails where there is none."""
    if not checkpoint_ready(df.sparkSession):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return cut_lineage(df)


def fenced(column: Column) -> Column:
    """The same values, but the optimizer leaves the column where it is computed.

    A filter on a column moves below the projection that makes it, with the whole expression
    in place of every mention of its parts: costly parts would be computed again for each
    mention, inside lambdas even for each element.  It does not move below an expression that
    depends on the partition's number.
    """
    return F.when(F.spark_partition_id() >= 0, column)


def held_out(id_column: Column, modulus: int, remainder: int) -> Column:
    """crc32 of the id's text has this remainder; false for a null id."""
    return F.coalesce(F.crc32(id_column.cast("string").cast("binary")) % modulus == remainder, F.lit(False))


def pieces(batches: Iterator[pa.RecordBatch], column: str, size: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches so that a piece holds about ``size`` bytes of one text column.

    A row is never split; a text above the size makes a piece of its own.
    """
    for batch in batches:
        texts = batch.column(batch.schema.get_field_index(column))
        start, held = 0, 0
        for i, n in enumerate(pa.compute.binary_length(texts).to_pylist()):
            if held and held + (n or 0) > size:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += n or 0
        if batch.num_rows > start:
            yield batch.slice(start)
