"""Session settings the operators count on, lineage cuts that survive lost executors, code for workers."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession

# Correctness needs the first; the others let Spark re-plan, split hot partitions and size
# broadcasts from measured statistics instead of hints.  The last bounds what a task reads of a shuffle:
# bytes are counted compressed, and rows of little more than a key take some twenty times as much memory.
SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16m",
}
# Partitions are only merged, so that bound needs enough of them to begin with.  Up to this many, Spark
# writes a shuffle straight to its files; beyond, a task holds and sorts its rows.
LEAST_PARTITIONS = 200
FIRST_PARTITIONS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"


def session_defaults(spark: SparkSession) -> SparkSession:
    for key, value in SESSION_DEFAULTS.items():
        spark.conf.set(key, value)
    asked = (spark.conf.get("spark.sql.shuffle.partitions"), spark.conf.get(FIRST_PARTITIONS, None) or 0)
    spark.conf.set(FIRST_PARTITIONS, max(LEAST_PARTITIONS, *map(int, asked)))
    return spark


def checkpoint_ready(spark: SparkSession) -> bool:
    """Make sure checkpoints have a home; False when there is none.

    The cluster names its shared folder in ``spark.checkpoint.dir``.  A folder of our own
    is set only where that is unset and everything runs in this one JVM.
    """
    context = spark.sparkContext
    if context.getCheckpointDir():
        return True
    configured = context.getConf().get("spark.checkpoint.dir") or spark.conf.get(
        "spark.checkpoint.dir", None
    )
    if configured:
        context.setCheckpointDir(configured)
        return True
    if context.master == "local" or context.master.startswith("local["):
        context.setCheckpointDir(tempfile.mkdtemp(prefix="tonflow-checkpoint-"))
        return True
    return False


def shared_folder(spark: SparkSession) -> str | None:
    """A new path below the checkpoint folder, or None when there is no such folder."""
    if not checkpoint_ready(spark):
        return None
    return f"{spark.sparkContext.getCheckpointDir()}/tonflow-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame, *by: str) -> DataFrame:
    """Write a table that several later plans read, and go on from the written copy, in folders ``by`` values.

    Columnar files, so later plans still prune columns, push filters down and size their
    joins from real statistics; lost executors cost nothing but a re-read.  Without a
    shared folder this fails: recomputing the input for each plan is no substitute.
    """
    folder = shared_folder(df.sparkSession)
    if folder is None:
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    df.write.mode("errorifexists").parquet(folder, partitionBy=list(by) or None)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


class Scratch:
    """Written copies that belong to one piece of work; each goes as soon as nothing needs it.

    A copy may be dropped once all that was built from it has been written itself.
    """

    def __init__(self, spark: SparkSession) -> None:
        self.spark = spark
        self._folders: dict[int, tuple[DataFrame, str]] = {}

    def keep(self, df: DataFrame, *replaced: DataFrame) -> DataFrame:
        """A written copy of ``df``; the copies it ``replaced`` are deleted."""
        folder = shared_folder(self.spark)
        if folder is None:
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        df.write.mode("errorifexists").parquet(folder)
        copy = self.spark.read.schema(df.schema).parquet(folder)
        self._folders[id(copy)] = (copy, folder)
        self.drop(*replaced)
        return copy

    def drop(self, *copies: DataFrame) -> None:
        for copy in copies:
            _, folder = self._folders.pop(id(copy), (None, None))
            if folder is not None:
                delete_path(self.spark, folder)


def delete_path(spark: SparkSession, path: str) -> None:
    """Delete a file or folder in whatever store Spark can reach."""
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(jvm_path, True)


def code_on_workers(spark: SparkSession) -> None:
    """Send this package to the workers if their path does not lead to it already."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    paths = [os.getcwd(), *os.environ.get("PYTHONPATH", "").split(os.pathsep)]
    known = any(p and os.path.isdir(p) and os.path.exists(os.path.join(p, "tonflow", "sources")) for p in paths)
    context = spark.sparkContext
    if known or getattr(context, "_tonflow_sent", False):
        return
    archive = os.path.join(tempfile.mkdtemp(prefix="tonflow-code-"), "tonflow.zip")
    with zipfile.ZipFile(archive, "w") as out:
        for folder, _, files in os.walk(os.path.join(root, "tonflow")):
            for name in files:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    out.write(path, os.path.relpath(path, root))
    context.addPyFile(archive)
    context._tonflow_sent = True
