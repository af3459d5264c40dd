"""Column functions. All are Spark SQL expressions, so they stay in generated code."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Severities and the channels they go to.
CHANNELS = {"CRITICAL": "#data-incidents", "WARNING": "#data-quality-drift"}


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_ts(c: Column | str, fmt: str | None = None) -> Column:
    """Text to timestamp; text that does not parse becomes NULL, also in ANSI mode."""
    return F.try_to_timestamp(_col(c), F.lit(fmt)) if fmt else F.try_to_timestamp(_col(c))


def seconds_between(start: Column | str, end: Column | str) -> Column:
    """Whole seconds from start to end."""
    return F.unix_timestamp(_col(end).cast("timestamp")) - F.unix_timestamp(
        _col(start).cast("timestamp")
    )


def ratio(num: Column, den: Column) -> Column:
    """num / den as double; NULL when den is zero."""
    return num.cast("double") / F.nullif(den.cast("double"), F.lit(0.0))


def json_text(c: Column | str, *keys: str, default: str | None = None) -> Column:
    """The first key of a JSON object that holds non-empty text, else the default."""
    found = [F.nullif(F.get_json_object(_col(c), f"$.{k}"), F.lit("")) for k in keys]
    return F.coalesce(*found, F.lit(default))


def json_double(c: Column | str, key: str, default: float = 0.0) -> Column:
    """A JSON field as double; the default when the text or the field is unusable."""
    value = F.get_json_object(_col(c), f"$.{key}").try_cast("double")
    return F.coalesce(value, F.lit(default))


def json_set(c: Column | str, key: str, value: Column) -> Column:
    """Set one top-level key of a JSON object of scalars and nested values.

    The object is read as a map of raw JSON fragments, so fields that are not
    touched keep their text.
    """
    fields = F.from_json(_col(c), "map<string,variant>")
    rest = F.map_filter(fields, lambda k, _: k != key)
    return F.to_json(F.map_concat(rest, F.create_map(F.lit(key), value)))


def fingerprint(c: Column | str) -> Column:
    """SHA-256 of bytes or text, as lowercase hex."""
    return F.sha2(_col(c).cast("binary"), 256)


def text_or_empty(c: Column | str) -> Column:
    """Trimmed text, with NULL as the empty string."""
    return F.trim(F.coalesce(_col(c), F.lit("")))


def channel(severity: Column | str) -> Column:
    """The channel an alert of this severity is sent to."""
    pairs = [F.lit(x) for kv in CHANNELS.items() for x in kv]
    return F.coalesce(F.create_map(*pairs)[_col(severity)], F.lit(CHANNELS["CRITICAL"]))


def l2_normalize(c: Column | str) -> Column:
    """A vector scaled to length one; a zero vector stays zero."""
    vec = _col(c)
    norm = F.sqrt(F.aggregate(vec, F.lit(0.0), lambda a, x: a + x.cast("double") * x))
    return F.transform(vec, lambda x: F.when(norm > 0, x / norm).otherwise(F.lit(0.0)).cast("float"))


def stable_id(*keys: Column | str) -> Column:
    """A row id that depends on the key alone, so a rerun gives the same ids.

    SHA-256 of the key as JSON, in which a NULL has its place: (NULL, 1) and (1, NULL) differ.
    """
    named = F.struct(*[_col(k).alias(f"k{i}") for i, k in enumerate(keys)])
    return F.sha2(F.to_json(named, {"ignoreNullFields": "false"}), 256)


def computed_once(df: DataFrame, keep: list[str], name: str, value: Column) -> DataFrame:
    """Columns ``keep`` and a value that is expensive to compute, such as parsed JSON.

    As the output of a generator the value is there before any later filter. In a
    plain projection a filter on it would be pushed below, with a second copy of
    the expression.
    """
    return df.select(*keep, F.inline(F.array(F.struct(value.alias(name)))))
