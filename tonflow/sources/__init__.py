"""Readers: catalog tables, files, JDBC, watermarked increments, file inventories."""

from tonflow.sources.files import file_inventory, read_csv_text
from tonflow.sources.increments import (
    add_batch_columns,
    high_watermark,
    increment,
    load_increment,
    with_columns_of,
)
from tonflow.sources.jdbc import JdbcSource, RetriesExhausted, newer_than, read_with_retry
from tonflow.sources.session import checkpoint_ready, cut_lineage, session_defaults, shared_folder
from tonflow.sources.tables import first_usable, inline_rows, optional_table, resolve, table_exists

__all__ = [
    "JdbcSource",
    "RetriesExhausted",
    "add_batch_columns",
    "checkpoint_ready",
    "cut_lineage",
    "file_inventory",
    "first_usable",
    "high_watermark",
    "increment",
    "inline_rows",
    "load_increment",
    "newer_than",
    "optional_table",
    "read_csv_text",
    "read_with_retry",
    "resolve",
    "session_defaults",
    "shared_folder",
    "table_exists",
    "with_columns_of",
]
