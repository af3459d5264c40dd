"""Structured Streaming."""

from tidewater.streaming.corrections import corrected_gold
from tidewater.streaming.expiry import first_within, rocksdb_state
from tidewater.streaming.layers import (
    append_batch,
    append_new,
    bronze_stream,
    dedup_stream,
    gold_stream,
    parse_json_payload,
    run_once,
    silver_rows,
    silver_stream,
    stop,
    stream_append,
    stream_to_memory,
    stream_to_table,
)
from tidewater.streaming.progress import ProgressRows, read_progress, recorded, state_rows

__all__ = [
    "ProgressRows",
    "append_batch",
    "append_new",
    "bronze_stream",
    "corrected_gold",
    "dedup_stream",
    "first_within",
    "gold_stream",
    "parse_json_payload",
    "read_progress",
    "recorded",
    "rocksdb_state",
    "run_once",
    "silver_rows",
    "silver_stream",
    "state_rows",
    "stop",
    "stream_append",
    "stream_to_memory",
    "stream_to_table",
]
