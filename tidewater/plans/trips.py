"""Trip pipelines: incremental ingestion of files, silver and gold tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.operators.clean import (
    TRIP,
    Trip,
    clean_basic,
    clean_strict,
    typed_trips,
    with_duration,
    with_lineage,
    with_pickup_date,
)
from tidewater.operators.dedup import dedup
from tidewater.operators.enrich import enrich_zones
from tidewater.operators.gold import gold_zone_period
from tidewater.session import staged
from tidewater.sinks import overwrite_partitions
from tidewater.sources import mark_processed, read_manifest, read_parquet, with_source_path


def clean_trips(
    raw: DataFrame, keys: list[str], order: list[str] | None = None, trip: Trip = TRIP
) -> DataFrame:
    """Parse, clean, deduplicate and derive the trips of one batch of files.

    Rows carry the file they came from (``source_path``), and copies are looked for within a file.
    """
    unique = dedup(clean_basic(typed_trips(raw, trip), trip), [*keys, "source_path"], order)
    return with_pickup_date(with_duration(unique, trip), trip)


def months_per_file(trips: DataFrame, ts: str, n: int | None) -> DataFrame:
    """Of each file the rows from n months before its newest one on."""
    if not n or n <= 0:
        return trips
    cutoffs = trips.groupBy("source_path").agg(F.add_months(F.max(ts), -n).alias("__from"))
    return trips.join(cutoffs, "source_path").filter(F.col(ts) >= F.col("__from")).drop("__from")


def ingest_inbox(
    spark: SparkSession,
    inbox_glob: str,
    manifest: str,
    out: str,
    zones: DataFrame,
    keys: list[str],
    order: list[str] | None = None,
    months: int | None = None,
    trip: Trip = TRIP,
    **lookup,
) -> int:
    """Process the files under a glob that no earlier run has; returns how many had rows.

    The inbox is a file stream, run until all that is there is taken: its checkpoint beside the
    manifest knows files by their full path, so files of equal name in two folders are two files, and no
    list of files goes through this function. Files that the manifest lists are left out as well.
    Output is partitioned by file and replaces that partition, so a run that died
    between the write and the manifest is simply repeated and leaves no second copy.
    """
    schema = read_parquet(spark, inbox_glob).schema
    inbox = with_source_path(with_lineage(spark.readStream.schema(schema).parquet(inbox_glob)))
    taken = [0]

    def process(batch: DataFrame, _: int) -> None:
        # The manifest grows with all runs; rows meet only those of its files that this batch holds again, mostly none.
        done = read_manifest(spark, manifest).select(F.col("path").alias("source_path"))
        again = staged(done.join(batch.select("source_path").distinct(), "source_path", "left_semi"), "files-again")
        fresh = batch.join(again, "source_path", "left_anti")
        trips = months_per_file(clean_trips(fresh, keys, order, trip), trip.pickup, months)
        rich = enrich_zones(trips, zones, trip.pickup_zone, trip.dropoff_zone, **lookup)
        overwrite_partitions(rich.withColumn("source_id", F.sha2("source_path", 256)), out, "source_id")
        files = fresh.groupBy(F.col("source_path").alias("path")).agg(F.any_value("source_file").alias("file_name"))
        files = staged(files, "files")
        mark_processed(files, manifest)
        taken[0] += files.count()

    query = inbox.writeStream.foreachBatch(process).option("checkpointLocation", f"{manifest}-checkpoint")
    query.trigger(availableNow=True).start().awaitTermination()
    return taken[0]


def silver_trips(bronze: DataFrame, zones: DataFrame, trip: Trip = TRIP, **lookup) -> DataFrame:
    """Typed, strictly cleaned trips with zone names and the pickup day to partition by."""
    clean = clean_strict(typed_trips(bronze, trip), trip)
    rich = enrich_zones(clean, zones, trip.pickup_zone, trip.dropoff_zone, **lookup)
    return with_pickup_date(rich, trip)


def gold_trips(silver: DataFrame, zone: str = "pickup_zone", trip: Trip = TRIP, unit: str = "hour") -> DataFrame:
    """Trips, average fare and average distance per pickup zone and hour."""
    return gold_zone_period(silver, zone, trip.pickup, trip.fare, trip.distance, unit)
