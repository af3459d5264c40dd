"""Sinks."""

from tidewater.sinks.tables import (
    append,
    append_nonempty,
    create_day_table,
    create_or_append,
    land_objects,
    overwrite,
    overwrite_partitions,
    overwrite_table,
    with_day,
)

__all__ = [
    "append",
    "append_nonempty",
    "create_day_table",
    "create_or_append",
    "land_objects",
    "overwrite",
    "overwrite_partitions",
    "overwrite_table",
    "with_day",
]
