"""Compare every registered query with its SQL on DuckDB.

    python -m verification.check [sf_dir] [query ...]

Prints one line per query; exits 1 if any differs.
"""

from __future__ import annotations

import sys
import time

import duckdb
import numpy as np
import pandas as pd
from pyspark.sql import SparkSession

from verification.cases import ORACLES, QUERIES

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()
UNWANTED = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython")


def canonical(df: pd.DataFrame, digits: int = 6) -> pd.DataFrame:
    """Columns by name, values as text, rows sorted."""

    def text(x) -> str:
        if x is None or x is pd.NaT or x is pd.NA or (isinstance(x, float) and np.isnan(x)):
            return "NULL"
        if isinstance(x, (bool, np.bool_)):
            return str(bool(x))
        if isinstance(x, (int, float, np.integer, np.floating)):
            return repr(round(float(x), digits) + 0.0)
        if hasattr(x, "isoformat"):
            stamp = pd.Timestamp(x)
            return str((stamp.tz_localize(None) if stamp.tzinfo else stamp).as_unit("us"))
        return str(x)

    out = pd.DataFrame({c: [text(x) for x in df[c].tolist()] for c in sorted(df.columns)})
    return out.sort_values(list(out.columns)).reset_index(drop=True)


def same(spark_rows: pd.DataFrame, sql_rows: pd.DataFrame) -> bool:
    if sorted(spark_rows.columns) != sorted(sql_rows.columns) or len(spark_rows) != len(sql_rows):
        return False
    return canonical(spark_rows).equals(canonical(sql_rows))


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    return con


def main() -> int:
    args = sys.argv[1:]
    folder = args.pop(0) if args and "/" in args[0] else "/root/testdata/sf0.01"
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, failed = connect(folder), []
    for name in args or QUERIES:
        start = time.time()
        try:
            df = QUERIES[name](spark, folder)
            rows = df.toPandas()
            plan = df._jdf.queryExecution().executedPlan().toString()
            note = [u for u in UNWANTED if u in plan]
            if name not in ORACLES:
                verdict = "rows only"
            else:
                verdict = "same" if same(rows, con.execute(ORACLES[name]).df()) else "DIFFERENT"
        except Exception as error:  # a failing query must not hide the others
            verdict, rows, note = f"ERROR {str(error)[:300]}", [], []
        if verdict.startswith(("DIFFERENT", "ERROR")):
            failed.append(name)
        print(f"{name:28s} {verdict:10s} rows={len(rows)} {time.time() - start:.1f}s {note or ''}", flush=True)
    print(f"{len(failed)} failed: {failed}")
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main())
