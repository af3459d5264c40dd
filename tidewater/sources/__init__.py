"""Sources."""

from tidewater.sources.files import (
    keep_ids,
    list_files,
    mark_processed,
    new_files,
    read_csv_dir,
    read_manifest,
    read_objects,
    read_parquet,
    read_texts,
    take_first,
    with_source_file,
    with_source_path,
)
from tidewater.sources.records import in_log_order, read_event_log, read_event_stream, with_record_meta
from tidewater.sources.tables import read_jdbc, read_table, read_table_stream

__all__ = [
    "in_log_order",
    "keep_ids",
    "list_files",
    "mark_processed",
    "new_files",
    "read_csv_dir",
    "read_event_log",
    "read_event_stream",
    "read_jdbc",
    "read_manifest",
    "read_objects",
    "read_parquet",
    "read_table",
    "read_table_stream",
    "read_texts",
    "take_first",
    "with_record_meta",
    "with_source_file",
    "with_source_path",
]
