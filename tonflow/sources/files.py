"""Files: text-only CSV and inventories of a folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tonflow.functions.codes import lookup

# --- Fixed values -----------------------------------------------------------------
FILE_KINDS = {
    "pdf": "PDF",
    "docx": "DOCX",
    "csv": "CSV",
    "png": "IMAGE",
    "jpg": "IMAGE",
    "jpeg": "IMAGE",
}
# --- end of fixed values ------------------------------------------------------------


def read_csv_text(spark: SparkSession, path: str) -> DataFrame:
    """CSV with a header and every column as text; quoted fields may span lines."""
    return spark.read.csv(path, header=True, inferSchema=False, multiLine=True, quote='"', escape='"')


def file_inventory(
    spark: SparkSession, folder: str, pattern: str = "*", recursive: bool = True
) -> DataFrame:
    """Name, size, kind and age of every file; the contents are never read."""
    reader = spark.read.format("binaryFile").option("pathGlobFilter", pattern)
    files = reader.option("recursiveFileLookup", str(recursive).lower()).load(folder)
    name = F.regexp_extract("path", r"([^/]+)$", 1)
    extension = F.lower(F.regexp_extract("path", r"\.([^./]+)$", 1))
    return files.select(
        "path",
        name.alias("file_name"),
        extension.alias("extension"),
        lookup(extension, FILE_KINDS, "OTHER").alias("kind"),
        F.col("length").alias("size_bytes"),
        F.round(F.col("length") / 1024.0, 2).alias("size_kb"),
        "modificationTime",
    )
