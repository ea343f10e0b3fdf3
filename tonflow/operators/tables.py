"""Table reads by condition, and table changes as DataFrame rewrites.

Changes return the whole new table as a DataFrame.  :func:`replace_table` writes it next to
the old one and only then switches, so a table is never overwritten while it is being read.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping, Sequence
from functools import reduce
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tonflow.functions.numbers import col
from tonflow.sources.session import cut_lineage, delete_path

# --- reading ------------------------------------------------------------------------


def all_equal(filters: Mapping[str, object]) -> Column:
    """AND of equalities as Columns; values are bound, never pasted into SQL text."""
    tests = [F.col(name) == F.lit(value) for name, value in filters.items()]
    return reduce(Column.__and__, tests, F.lit(True))


def find(df: DataFrame, **filters) -> DataFrame:
    return df.where(all_equal(filters))


def page(
    df: DataFrame,
    order: Sequence[str | Column],
    limit: int = 10,
    offset: int = 0,
    filters: Mapping[str, object] | None = None,
) -> DataFrame:
    """One page of rows under a total order."""
    return df.where(all_equal(filters or {})).orderBy(*order).offset(offset).limit(limit)


def page_total(df: DataFrame, filters: Mapping[str, object] | None = None) -> DataFrame:
    return df.where(all_equal(filters or {})).agg(F.count(F.lit(1)).alias("total"))


def duplicates(df: DataFrame, keys: Sequence[str], top: int | None = None) -> DataFrame:
    """Keys that occur more than once, most frequent first."""
    found = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("duplicate_count"))
    found = found.where("duplicate_count > 1").orderBy(F.desc("duplicate_count"), *keys)
    return found if top is None else found.limit(top)


def query(spark: SparkSession, sql: str, **args) -> DataFrame:
    """SQL with bound ``:name`` parameters."""
    return spark.sql(sql, args=args)


def surrogate_key(*parts: Column | str) -> Column:
    """SHA-256 over parts joined by ``|``."""
    return F.sha2(F.concat_ws("|", *map(col, parts)), 256)


# --- changing -----------------------------------------------------------------------


def insert_rows(df: DataFrame, rows: DataFrame) -> DataFrame:
    """Append; columns the new rows lack are NULL, columns the table lacks are refused."""
    unknown = set(rows.columns) - set(df.columns)
    if unknown:
        raise ValueError(f"not columns of the table: {sorted(unknown)}")
    return df.unionByName(rows, allowMissingColumns=True).select(*df.columns)


def update_where(df: DataFrame, condition: Column, changes: Mapping[str, object]) -> DataFrame:
    """Set columns where a condition holds; nothing to set leaves the table as it is."""
    types = dict(df.dtypes)

    def new(name: str) -> Column:
        value = changes[name]
        value = value if isinstance(value, Column) else F.lit(value)
        return F.when(condition, value.cast(types[name])).otherwise(F.col(name)).alias(name)

    return df.select(*[new(c) if c in changes else F.col(c) for c in df.columns])


def delete_where(df: DataFrame, condition: Column) -> DataFrame:
    """Everything but the rows for which the condition is true (NULL keeps the row)."""
    return df.where(~F.coalesce(condition, F.lit(False)))


def empty_like(df: DataFrame) -> DataFrame:
    return df.limit(0)


def merge_upsert(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    newer: str | None = None,
    update: Sequence[str] | None = None,
    null_safe: bool = True,
) -> DataFrame:
    """Target with source merged in by key.

    Matching rows take the source's ``update`` columns (default: all), or only where the
    source's ``newer`` column is larger.  Keys the target lacks are inserted.  With
    ``null_safe`` a NULL key matches a NULL key; otherwise NULL keys never match.  A key
    that occurs twice in the source fails the job, as a MERGE does.

    Built as (target left join source) plus (source without target keys): a left join can
    be split on a hot key, a full outer join cannot.
    """
    keys = list(keys)
    others = [c for c in target.columns if c not in keys]
    update = others if update is None else list(update)
    once = source.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_n"),
        F.first(F.struct(*[c for c in source.columns if c not in keys])).alias("_row"),
    )
    refusal = F.raise_error(F.lit("merge source has a key more than once")).cast("boolean")
    repeated = F.col("_n") > 1
    if not null_safe:
        # NULL keys match nothing, so repeating them is no conflict: all are inserted.
        for k in keys:
            repeated = repeated & F.col(k).isNotNull()
    once = once.where(F.when(repeated, refusal).otherwise(F.lit(True)))

    renamed = once.select(*[F.col(k).alias(f"_s_{k}") for k in keys], F.col("_row"))

    def on(left: Sequence[str], right: Sequence[str]) -> Column:
        same = Column.eqNullSafe if null_safe else Column.__eq__
        return reduce(Column.__and__, [same(F.col(a), F.col(b)) for a, b in zip(left, right)])

    joined = target.join(renamed, on(keys, [f"_s_{k}" for k in keys]), "left")
    take = F.col("_row").isNotNull()
    if newer is not None:
        take = take & F.coalesce(F.col(f"_row.{newer}") > F.col(newer), F.lit(False))
    kept = joined.select(
        *[
            F.when(take, F.col(f"_row.{c}")).otherwise(F.col(c)).alias(c) if c in update else F.col(c)
            for c in target.columns
        ]
    )
    known = target.select(*[F.col(k).alias(f"_t_{k}") for k in keys])
    new = source.join(known, on(keys, [f"_t_{k}" for k in keys]), "left_anti")
    return kept.unionByName(new.select(*target.columns))


# --- writing ------------------------------------------------------------------------


def write_table(
    df: DataFrame,
    name: str,
    mode: str = "overwrite",
    partition_by: Sequence[str] = (),
    comment: str | None = None,
    fmt: str = "parquet",
) -> DataFrame:
    """Save as a catalog table and return it read back, so later steps start from the table."""
    spark = df.sparkSession
    writer = df.write.format(fmt).mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.saveAsTable(name)
    if comment:
        quoted = comment.replace("\\", "\\\\").replace("'", "\\'")
        spark.sql(f"COMMENT ON TABLE {name} IS '{quoted}'")
    return spark.table(name)


def append(df: DataFrame, name: str, fmt: str = "parquet") -> DataFrame:
    return write_table(df, name, "append", fmt=fmt)


def drop_table(spark: SparkSession, name: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def temp_view(df: DataFrame, name: str) -> DataFrame:
    df.createOrReplaceTempView(name)
    return df


def _layout(spark: SparkSession, name: str) -> tuple[list[str], str, str | None]:
    """Partition columns, format and comment of a table."""
    details = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect()}
    partitions = [c.name for c in spark.catalog.listColumns(name) if c.isPartition]
    return partitions, details.get("Provider", "parquet"), details.get("Comment")


def write_counted(df: DataFrame, name: str, mode: str = "append", **options) -> tuple[DataFrame, int]:
    """:func:`write_table`, and how many rows were written; counted as they pass."""
    seen = Observation(f"written_{uuid.uuid4().hex[:12]}")
    table = write_table(df.observe(seen, F.count(F.lit(1)).alias("rows")), name, mode, **options)
    return table, seen.get["rows"]


#: Table properties that name a written but not yet finished change, and a folder left behind by one.
PENDING, LEFT = "tonflow.pending", "tonflow.left"


def _location(spark: SparkSession, name: str, partition: str = "") -> str | None:
    """Folder of a table or of one of its partitions; None where the partition is not known."""
    try:
        rows = spark.sql(f"DESCRIBE TABLE EXTENDED {name} {partition}").collect()
    except AnalysisException:
        if not partition:
            raise
        return None
    # A partition's own location comes before that of its table.
    return next(r["data_type"] for r in rows if r["col_name"] == "Location")


def _spec(values: Mapping[str, object]) -> str:
    def text(value: object) -> str:
        if value is None:
            return "null"
        quoted = str(value).replace("\\", "\\\\").replace("'", "\\'")
        return f"'{quoted}'"

    return "PARTITION (" + ", ".join(f"`{c}` = {text(v)}" for c, v in values.items()) + ")"


def finish_change(spark: SparkSession, name: str) -> bool:
    """Finish a change of partitions that was written and announced, but cut off; False if there is none.

    Each step may be repeated: partitions are pointed to their new folders, those left without
    rows are dropped, the announcement goes, and only then the old folders.
    """
    properties = {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {name}").collect()}
    left = properties.get(LEFT)
    if left is not None:
        if left != _location(spark, name):  # else the table was not yet pointed away from it
            delete_path(spark, left)
        spark.sql(f"ALTER TABLE {name} UNSET TBLPROPERTIES IF EXISTS ('{LEFT}')")
    folder = properties.get(PENDING)
    if folder is None:
        return left is not None
    steps = spark.read.parquet(f"{folder}/_manifest").collect()
    for step in steps:
        spec = _spec(step["partition"].asDict())
        if step["place"] is None:
            spark.sql(f"ALTER TABLE {name} DROP IF EXISTS {spec}")
            continue
        place = step["place"].replace("'", "\\'")
        spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS {spec} LOCATION '{place}'")
        spark.sql(f"ALTER TABLE {name} {spec} SET LOCATION '{place}'")
    spark.sql(f"ALTER TABLE {name} UNSET TBLPROPERTIES IF EXISTS ('{PENDING}')")
    spark.catalog.refreshTable(name)
    for step in steps:
        if step["old"] is not None and step["old"] != step["place"]:
            delete_path(spark, step["old"])
    return True


def _switch_partitions(df: DataFrame, name: str, touched: Sequence[Mapping[str, object]]) -> DataFrame:
    """Put ``df`` in place of the ``touched`` partitions of a table; others are not looked at.

    The rows are written to a new folder within the table's, which readers don't see.  A manifest
    beside them tells where each partition is to lead; one table property announces it.  From then on
    :func:`finish_change` can be repeated until it gets through, so nothing is lost whatever fails.
    """
    spark = df.sparkSession
    table = spark.table(name)
    partitions, provider, _ = _layout(spark, name)
    folder = f"{_location(spark, name)}/_versions/{uuid.uuid4().hex[:12]}"
    df.select(*table.columns).write.format(provider).partitionBy(*partitions).save(folder)
    written = spark.read.format(provider).schema(table.schema).load(folder)
    places = written.select(*partitions, F.input_file_name().alias("_file")).groupBy(*partitions).agg(F.min("_file").alias("_file")).collect()
    new = {tuple(r[c] for c in partitions): unquote(r["_file"].rsplit("/", 1)[0]) for r in places}
    wanted = {tuple(t[c] for c in partitions) for t in touched} | set(new)
    rows = []
    for values in sorted(wanted, key=repr):
        partition = dict(zip(partitions, values))
        rows.append(({c: None if v is None else str(v) for c, v in partition.items()}, new.get(values), _location(spark, name, _spec(partition))))
    kind = "struct<" + ", ".join(f"`{c}`: string" for c in partitions) + ">"
    manifest = spark.createDataFrame(rows, f"partition {kind}, place string, old string")
    manifest.coalesce(1).write.parquet(f"{folder}/_manifest")
    spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ('{PENDING}' = '{folder}')")
    finish_change(spark, name)
    return spark.table(name)


def replace_table(df: DataFrame, name: str, fmt: str | None = None) -> DataFrame:
    """Replace a table by a DataFrame that may itself read that table.

    The new rows are written to a new folder first.  Then the table is pointed there, which is one
    change in the catalog, and only then the old folder is deleted: at every moment there is a
    complete table.  The partitions of a partitioned table are pointed to their new folders
    one by one (:func:`finish_change` completes that after a crash).  Format, partitioning and
    comment stay.  Other columns than before make it a new table of the same name.
    """
    spark = df.sparkSession
    if not spark.catalog.tableExists(name):
        return write_table(df, name, "errorifexists", fmt=fmt or "parquet")
    finish_change(spark, name)
    partitions, provider, comment = _layout(spark, name)
    table = spark.table(name)
    same = dict(df.dtypes) == dict(table.dtypes) and fmt in (None, provider)
    if not same:
        return _rename_in(df, name, fmt or provider, comment)
    if partitions:
        touched = [r.asDict() for r in table.select(*partitions).distinct().collect()]
        return _switch_partitions(df, name, touched)
    old = _location(spark, name)
    parent, own = old.rstrip("/").rsplit("/", 1)
    place = f"{parent}/{own.split('__')[0]}__{uuid.uuid4().hex[:12]}"
    df.select(*table.columns).write.format(provider).save(place)
    spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ('{LEFT}' = '{old}')")
    spark.sql(f"ALTER TABLE {name} SET LOCATION '{place}'")
    spark.catalog.refreshTable(name)
    finish_change(spark, name)
    return spark.table(name)


def _rename_in(df: DataFrame, name: str, fmt: str, comment: str | None) -> DataFrame:
    """A table of other columns takes the name: the old one is renamed away first, dropped last."""
    spark = df.sparkSession
    mark = uuid.uuid4().hex[:12]
    staged, aside = f"{name}_new_{mark}", f"{name}_old_{mark}"
    write_table(df, staged, "errorifexists", (), comment, fmt)
    spark.sql(f"ALTER TABLE {name} RENAME TO {aside}")
    try:
        spark.sql(f"ALTER TABLE {staged} RENAME TO {name}")
    except Exception:
        spark.sql(f"ALTER TABLE {aside} RENAME TO {name}")
        raise
    drop_table(spark, aside)
    return spark.table(name)


def upsert_table(df: DataFrame, name: str, keys: Sequence[str], newer: str | None = None) -> DataFrame:
    """Merge into a table, creating it on the first run.

    Of a partitioned table only the partitions are rewritten that the source's rows go to or that hold
    a row with a source's key; where the keys contain the partition columns, these are the
    source's own, else a scan of the key columns finds them.
    """
    spark = df.sparkSession
    if not spark.catalog.tableExists(name):
        return write_table(df, name)
    finish_change(spark, name)
    partitions, _, _ = _layout(spark, name)
    target = spark.table(name)
    if not partitions:
        return replace_table(merge_upsert(target, df, keys, newer), name)
    source = cut_lineage(df)
    touched = source.select(*partitions)
    if not set(partitions) <= set(keys):
        known = source.select(*[F.col(k).alias(f"_s_{k}") for k in keys])
        alike = reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(f"_s_{k}")) for k in keys])
        touched = touched.unionByName(target.join(known, alike, "left_semi").select(*partitions))
    touched = [r.asDict() for r in touched.distinct().collect()]  # one row per partition
    if not touched:
        return target
    here = [reduce(Column.__and__, [F.col(c).eqNullSafe(F.lit(v)) for c, v in t.items()]) for t in touched]
    part = target.where(reduce(Column.__or__, here))
    return _switch_partitions(merge_upsert(part, source, keys, newer), name, touched)


def truncate_table(spark: SparkSession, name: str) -> DataFrame:
    return replace_table(empty_like(spark.table(name)), name)


class ArchiveIncomplete(RuntimeError):
    """The archive lacks rows that were about to be pruned; nothing was pruned."""


def archive_and_prune(
    spark: SparkSession,
    table: str,
    archive: str,
    date_column: str,
    keep_months: int = 3,
    as_of: str | None = None,
    read: Callable[[], DataFrame | None] | None = None,
    write: Callable[[DataFrame], None] | None = None,
) -> dict:
    """Copy rows older than ``keep_months`` to an archive table, then remove them.

    The old rows are written down once, at the start.  Whole rows are compared with the archive, by a
    digest of all columns, NULLs like values and repeated rows by their number: what the archive
    lacks is appended, and pruning happens only when it lacks nothing any more.  Exactly the rows
    written down are pruned; old rows that turn up meanwhile wait for the next run.  A run that
    died half way can simply be repeated.  The archive is a catalog table unless
    ``read`` (None where there is none yet) and ``write`` lead elsewhere, to a database say.
    """
    read = read or (lambda: spark.table(archive) if spark.catalog.tableExists(archive) else None)
    write = write or (lambda rows: rows.write.mode("append").saveAsTable(archive))
    today = F.lit(as_of).cast("date") if as_of else F.current_date()
    # The cutoff is fixed once so that all steps agree on it, and so are the rows.
    cutoff = F.lit(spark.range(1).select(F.add_months(today, -keep_months).alias("d")).first()["d"])
    is_old = F.col(date_column) < cutoff
    live = spark.table(table)
    old = cut_lineage(_numbered(live.where(is_old)))
    result = {"table": table, "old_rows": old.count(), "archived": False, "pruned": False}
    if not result["old_rows"]:
        return result

    def missing() -> DataFrame:
        done = read()
        if done is None:
            return old
        known = _numbered(done.where(is_old).select(*live.columns)).select(*_ROW)
        return old.join(known, _ROW, "left_anti")

    write(missing().select(*live.columns))
    result["archived"] = True
    if not missing().isEmpty():
        raise ArchiveIncomplete(f"{archive} lacks old rows of {table}")
    # Rows that turned up since are not among those archived, and stay.
    now = spark.table(table)
    late = _numbered(now.where(is_old)).join(old.select(*_ROW), _ROW, "left_anti").select(*live.columns)
    replace_table(delete_where(now, is_old).unionByName(late), table)
    return result | {"pruned": True}


_ROW = ["_row_digest", "_row_copy"]


def _numbered(df: DataFrame) -> DataFrame:
    """Rows with a digest of all their values, and a number that tells equal rows apart."""
    digest = F.sha2(F.to_json(F.struct(*df.columns)), 256)
    copy = F.row_number().over(W.partitionBy("_row_digest").orderBy(F.lit(0)))
    return df.withColumn("_row_digest", digest).withColumn("_row_copy", copy)
