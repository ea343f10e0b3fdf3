"""A few registered queries of every kind against their SQL; all of them are compared by
``python -m verification.check``."""

import os

import pytest

import __spark_entry__ as entry_point
from verification.check import connect, same

FOLDER = "/root/testdata/sf0.001"
SAMPLE = [
    "trip_reconciliation", "contractor_daily", "drop_repeats", "plant_output", "merge_newer", "increment_overlap",
    "truck_pairs", "stream_spacing", "pair_similarity", "similar_documents", "table_cells", "parse_timestamps",
]
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="needs the given tables")


@pytest.fixture(scope="module")
def sql():
    return connect(FOLDER)


@pytest.mark.parametrize("name", SAMPLE)
def test_same_rows_as_sql(spark, sql, name):
    rows = entry_point.queries()[name](spark, FOLDER).toPandas()
    assert same(rows, sql.execute(entry_point.oracle_sql()[name]).df())


def test_entry_and_registration(spark):
    assert entry_point.entry(spark).count() > 0
    assert set(entry_point.oracle_sql()) <= set(entry_point.queries())
