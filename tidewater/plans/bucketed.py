"""Merges into a Parquet table that is partitioned by a hash of its key, rewriting only what a batch touches.

The partition column names the number of buckets (``bucket_of_64=17``), so a table cannot be read with
another number by mistake. A merge takes the buckets of its batch, at most as many numbers as there are buckets, reads these
partitions alone, and replaces them by dynamic partition overwrite; the files of all other buckets stay as
they are. A merge that failed is run again: upserts and change events give the same table the second time. A table has
one writer at a time. Rows with a NULL in the key are in one bucket and match nothing.

Choose the number so that a bucket is a few files of a task's size: a batch of few keys then costs a few buckets, whatever
the size of the table.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tidewater.operators.merge import merge_cdc, merge_upsert
from tidewater.plans.cdc import apply_changes
from tidewater.session import drop_path, observed, staged
from tidewater.sinks import overwrite_partitions

Merge = Callable[[DataFrame, DataFrame], DataFrame]


def bucket_name(buckets: int) -> str:
    """The partition column of a table with that many buckets."""
    return f"bucket_of_{buckets}"


def bucket_of(keys: list[str], buckets: int) -> Column:
    """The bucket of a row."""
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int").alias(bucket_name(buckets))


def write_bucketed(df: DataFrame, path: str, keys: list[str], buckets: int) -> None:
    """Write a whole table; buckets it has no rows for keep what they held."""
    overwrite_partitions(df.select("*", bucket_of(keys, buckets)), path, bucket_name(buckets))


def read_bucketed(spark: SparkSession, path: str, buckets: int, only: list[int] | None = None) -> DataFrame:
    """The table, or some buckets of it, without the partition column."""
    rows = spark.read.parquet(path)
    name = bucket_name(buckets)
    if name not in rows.columns:
        raise ValueError(f"{path} is not a table of {buckets} buckets: {rows.columns}")
    return (rows if only is None else rows.filter(F.col(name).isin(only))).drop(name)


def touched(batch: DataFrame, keys: list[str], buckets: int) -> list[int]:
    """The buckets of a batch's rows."""
    name = bucket_name(buckets)
    return sorted(r[name] for r in batch.select(bucket_of(keys, buckets)).distinct().collect())


def merge_bucketed(
    spark: SparkSession, path: str, batch: DataFrame, keys: list[str], buckets: int, merge: Merge,
    empty: DataFrame, batch_keys: list[str] | None = None,
) -> list[int]:
    """Replace the batch's buckets by ``merge(target, batch)`` of their rows; returns the buckets.

    ``empty`` has the table's columns, for the first run. ``batch_keys`` names the key's columns in
    the batch where they differ. The batch is staged, as it is read for its buckets and for the merge. Buckets that
    have no rows after the merge are removed.
    """
    batch = staged(batch, "merge-batch")
    name = bucket_name(buckets)
    of = dict(zip(batch_keys or keys, keys))
    renamed = batch.select(*[F.col(b).alias(k) for b, k in of.items()])
    hit = touched(renamed, keys, buckets)
    if not hit:
        return hit
    try:
        target = read_bucketed(spark, path, buckets, hit).select(*empty.columns)
    except AnalysisException as error:
        if error.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        target = empty.limit(0)
    left = Observation()
    after = merge(target, batch).select("*", bucket_of(keys, buckets))
    overwrite_partitions(after.observe(left, F.collect_set(name).alias("buckets")), path, name)
    gone = sorted(set(hit) - set(observed(left, buckets=[])["buckets"]))
    for bucket in gone:
        drop_path(spark, f"{path}/{name}={bucket}")
    return hit


def upsert_bucketed(spark: SparkSession, path: str, source: DataFrame, keys: list[str], buckets: int) -> list[int]:
    """:func:`merge_upsert` into a bucketed table, which the first run creates."""
    return merge_bucketed(spark, path, source, keys, buckets, lambda t, s: merge_upsert(t, s, keys), source)


def merge_cdc_bucketed(
    spark: SparkSession, path: str, changes: DataFrame, key: str, values: dict[str, str], buckets: int,
    empty: DataFrame, change_key: str = "entity_id", **kinds,
) -> list[int]:
    """:func:`merge_cdc` into a bucketed table: one event per key, deleted rows go."""
    changes = changes.filter(F.col(change_key).isNotNull())

    def merge(target: DataFrame, batch: DataFrame) -> DataFrame:
        return merge_cdc(target, batch, key, values, change_key, **kinds)

    return merge_bucketed(spark, path, changes, [key], buckets, merge, empty, [change_key])


def apply_changes_bucketed(
    spark: SparkSession, path: str, events: DataFrame, key: str, values: list[str], buckets: int,
    empty: DataFrame, table: str | None = None,
) -> list[int]:
    """:func:`apply_changes` to a bucketed mirror: any events, older ones change nothing."""
    keyed = events.withColumn("__key", F.coalesce(f"after_{key}", f"before_{key}")).filter(F.col("__key").isNotNull())

    def merge(target: DataFrame, batch: DataFrame) -> DataFrame:
        return apply_changes(target, batch.drop("__key"), key, values, table)

    return merge_bucketed(spark, path, keyed, [key], buckets, merge, empty, ["__key"])
