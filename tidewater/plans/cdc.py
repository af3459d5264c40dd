"""From the change log to a current-state mirror."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.operators.cdc import for_table, latest_changes, with_entity_key
from tidewater.operators.dedup import latest_per_key
from tidewater.operators.merge import no_null

UPSERTS = ("c", "u", "r")


def apply_changes(
    mirror: DataFrame, events: DataFrame, key: str, values: list[str], table: str | None = None
) -> DataFrame:
    """The mirror after flat change events, of ``table`` if one is named.

    A row gives way only to a later event, by time and then place in the log
    (``last_updated_ms``, and ``last_lsn`` where the mirror has it), so a batch that is
    applied again, or late, changes nothing. A mirror with a column ``deleted`` keeps
    deleted keys, marked and with their time, so that a replayed insert does not bring them
    back; read it through :func:`current`. A mirror without that column forgets them.

    Rows and changes are stacked, and the latest of each key stays: one shuffle, with
    partial reduction before it. Rows with a NULL key are kept as they are.
    """
    if table is not None:
        events = for_table(events, table)
    kept = [c for c in mirror.columns if c not in {key, *values, "last_updated_ms", "last_lsn", "deleted"}]
    has = set(mirror.columns)
    old = mirror.select(
        key,
        "last_updated_ms",
        (F.col("last_lsn") if "last_lsn" in has else F.lit(None).cast("bigint")).alias("last_lsn"),
        (F.col("deleted") if "deleted" in has else F.lit(False)).alias("deleted"),
        F.lit(0).alias("__new"),
        F.struct(*[F.col(v) for v in values]).alias("__v"),
        F.struct(*[F.col(c) for c in kept], F.lit(1).alias("__1")).alias("__rest"),
    )
    change = latest_changes(with_entity_key(events, key)).filter(F.col("op").isin("d", *UPSERTS))
    new = change.select(
        F.col("entity_id").alias(key),
        F.col("ts_ms").alias("last_updated_ms"),
        F.col("source_lsn").alias("last_lsn"),
        (F.col("op") == "d").alias("deleted"),
        F.lit(1).alias("__new"),
        F.struct(*[F.when(F.col("op") != "d", F.col(f"after_{v}")).alias(v) for v in values]).alias("__v"),
        F.lit(None).cast(old.schema["__rest"].dataType).alias("__rest"),
    )
    both = old.filter(no_null([key])).unionByName(new.filter(no_null([key])))
    # Without a log position in the mirror, an event of the row's own time is taken for the row's.
    order = ["last_updated_ms", "last_lsn"] if "last_lsn" in has else ["last_updated_ms"]
    latest = latest_per_key(both, [key], [*order, "__new"])
    if kept:
        rest = old.filter(no_null([key])).select(key, F.col("__rest").alias("__old"))
        latest = latest.join(rest, key, "left").withColumn("__rest", F.coalesce("__rest", "__old"))
    if "deleted" not in has:
        latest = latest.filter(~F.col("deleted"))
    latest = latest.unionByName(old.filter(~no_null([key])), allowMissingColumns=True)
    return latest.select(
        *[
            F.col(f"__v.{c}").alias(c) if c in values else F.col(f"__rest.{c}").alias(c) if c in kept else F.col(c)
            for c in mirror.columns
        ]
    )


def current(mirror: DataFrame) -> DataFrame:
    """What readers of a mirror see: its rows but for the deleted ones."""
    return mirror.filter(~F.col("deleted")).drop("deleted", "last_lsn")
