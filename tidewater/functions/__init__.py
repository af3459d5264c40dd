"""Column functions."""

from tidewater.functions.scalars import (
    CHANNELS,
    channel,
    computed_once,
    fingerprint,
    json_double,
    json_set,
    json_text,
    l2_normalize,
    parse_ts,
    ratio,
    seconds_between,
    stable_id,
    text_or_empty,
)

__all__ = [
    "CHANNELS",
    "channel",
    "computed_once",
    "fingerprint",
    "json_double",
    "json_set",
    "json_text",
    "l2_normalize",
    "parse_ts",
    "ratio",
    "seconds_between",
    "stable_id",
    "text_or_empty",
]
