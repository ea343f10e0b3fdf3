"""Structured Streaming: sources, sinks, spacing between trucks, incremental tables."""

from tonflow.streaming.flows import AppendFlow, run_flow, run_flows
from tonflow.streaming.live import (
    event_time,
    file_stream,
    rollup_stream,
    spacing_stream,
    speed_stream,
    table_stream,
    to_files,
    to_table,
)
from tonflow.streaming.watch import StreamLog, watched

__all__ = [
    "AppendFlow",
    "StreamLog",
    "event_time",
    "file_stream",
    "rollup_stream",
    "run_flow",
    "run_flows",
    "spacing_stream",
    "speed_stream",
    "table_stream",
    "to_files",
    "to_table",
    "watched",
]
