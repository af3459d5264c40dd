"""Structured Streaming: bronze, silver and gold queries and the ways to run them."""

from __future__ import annotations

from datetime import date

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from tidewater.functions import computed_once, parse_ts
from tidewater.operators.clean import clean_ts
from tidewater.operators.dedup import dedup, dedup_against
from tidewater.operators.enrich import enrich_zones
from tidewater.operators.gold import gold_zone_hour_window
from tidewater.session import staged
from tidewater.sources.records import with_record_meta


# The day of rows without a time.
NO_DAY = "1000-01-01"


# -- running -----------------------------------------------------------------


def _writer(df: DataFrame, checkpoint: str, trigger: str | None, mode: str = "append"):
    writer = df.writeStream.outputMode(mode).option("checkpointLocation", checkpoint)
    if trigger is None:
        return writer.trigger(availableNow=True)
    return writer.trigger(processingTime=trigger)


def stream_append(
    df: DataFrame, path: str, checkpoint: str, trigger: str | None = None,
    partition_by: tuple[str, ...] = (), name: str | None = None,
) -> StreamingQuery:
    """Start appending a stream to a Parquet folder.

    Without a trigger interval the query takes all data that is there and ends;
    started again on its checkpoint it goes on behind what it took.
    """
    writer = _writer(df, checkpoint, trigger).format("parquet").option("path", path)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if name:
        writer = writer.queryName(name)
    return writer.start()


def stream_to_table(df: DataFrame, table: str, checkpoint: str, trigger: str | None = None) -> StreamingQuery:
    """Start appending a stream to a catalog table."""
    return _writer(df, checkpoint, trigger).toTable(table)


def stream_to_memory(
    df: DataFrame, name: str, checkpoint: str | None = None, mode: str = "append", trigger: str | None = None
) -> StreamingQuery:
    """Start a stream into an in-memory table, to look at it by SQL.

    The rows end up in the driver, so this is for a glance at a stream, not for data.
    """
    for query in df.sparkSession.streams.active:
        if query.name == name:
            query.stop()
    writer = df.writeStream.outputMode(mode)
    if checkpoint:
        writer = writer.option("checkpointLocation", checkpoint)
    writer = writer.trigger(processingTime=trigger) if trigger else writer.trigger(availableNow=True)
    return writer.format("memory").queryName(name).start()


def run_once(df: DataFrame, path: str, checkpoint: str, **options) -> None:
    """Append all data that is there, and wait for it."""
    stream_append(df, path, checkpoint, **options).awaitTermination()


def stop(spark: SparkSession, name: str) -> None:
    """Stop the active query of a name."""
    for query in spark.streams.active:
        if query.name == name:
            query.stop()


# -- layers ------------------------------------------------------------------


def bronze_stream(records: DataFrame) -> DataFrame:
    """Payload as text beside the record's place in the log."""
    return with_record_meta(records)


def parse_json_payload(df: DataFrame, schema: StructType | str, value: str = "value") -> DataFrame:
    """The fields of a JSON payload, typed by a declared schema, in place of the payload.

    A field that does not fit its type is NULL; names match by case.
    """
    keep = [c for c in df.columns if c != value]
    return computed_once(df, keep, "d", F.from_json(F.col(value).cast("string"), schema)).select(*keep, "d.*")


def dedup_stream(
    df: DataFrame,
    keys: list[str],
    ts: str | None = None,
    delay: str | None = None,
    salt: Column | None = None,
    salts: int = 32,
) -> DataFrame:
    """The first row of each key in a stream.

    With a delay the state stays bounded. If the event time is part of the key,
    its copies share one time and are dropped as long as they are not later than
    the delay; otherwise a key is remembered for the delay after its first row. A row that
    comes later than the delay is dropped even if its key is new: Spark cannot tell. Without a
    delay every key is remembered for good. :func:`append_new` has neither limit.

    All copies of a key meet in one state partition. For keys with very many
    copies give a ``salt`` that differs between copies, such as the log offset:
    a first pass then drops copies within ``salts`` sub-keys, and the second pass
    sees at most that many rows per key.
    """
    if delay is not None:
        df = df.withWatermark(ts, delay)

    def first(rows: DataFrame, by: list[str]) -> DataFrame:
        if delay is not None and ts not in keys:
            return rows.dropDuplicatesWithinWatermark(by)
        return rows.dropDuplicates(by)

    if salt is not None:
        df = first(df.withColumn("__salt", F.pmod(F.hash(salt), F.lit(salts))), [*keys, "__salt"]).drop("__salt")
    return first(df, keys)


def append_batch(batch: DataFrame, path: str, keys: list[str], ts: str) -> list[date]:
    """Append those rows of a batch whose key the dataset does not hold yet; returns the days of the batch.

    The dataset is partitioned by ``<ts>_day``. The batch's days, as many as it has, come to the driver and are
    literals of the scan, so that other partitions are not read. Rows without a time are one more day.
    """
    day = f"{ts}_day"
    batch = batch.withColumn(day, F.coalesce(F.to_date(ts), F.lit(NO_DAY).cast("date")))
    unique = staged(dedup(batch, keys), "stream-batch")
    days = sorted(r[day] for r in unique.select(day).distinct().collect())
    try:
        held = batch.sparkSession.read.schema(unique.schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        held = unique.limit(0)
    seen = held.filter(F.col(day).isin(days))
    dedup_against(unique, seen, keys).write.mode("append").partitionBy(day).parquet(path)
    return days


def append_new(
    df: DataFrame, path: str, checkpoint: str, keys: list[str], ts: str, trigger: str | None = None
) -> StreamingQuery:
    """Start appending those rows of a stream whose key the dataset does not hold yet.

    Each micro-batch keeps one row per key and is compared with what the dataset holds of
    the batch's days only (it is partitioned by ``<ts>_day``; the time belongs to the key, so copies share
    a day). Nothing is remembered between batches and no row is lost to lateness. A batch
    that is retried finds its rows and adds nothing. Rows without a time are one more day.
    """
    if ts not in keys:
        raise ValueError(f"{ts} has to be one of the keys, so that copies are found on one day")

    def write(batch: DataFrame, _: int) -> None:
        append_batch(batch, path, keys, ts)

    writer = df.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if trigger is None else writer.trigger(processingTime=trigger)
    return writer.start()


def silver_rows(
    bronze: DataFrame,
    zones: DataFrame,
    schema: StructType | str,
    pickup: str = "tpep_pickup_datetime",
    dropoff: str = "tpep_dropoff_datetime",
    pickup_zone: str | None = "PULocationID",
    dropoff_zone: str | None = "DOLocationID",
    **lookup,
) -> DataFrame:
    """Parse, drop rows without times, look zones up; copies are left to :func:`append_new`."""
    parsed = parse_json_payload(bronze, schema)
    timed = clean_ts(
        parsed.withColumns({"pickup_ts": parse_ts(pickup), "dropoff_ts": parse_ts(dropoff)}).drop(pickup, dropoff)
    )
    return enrich_zones(timed, zones, pickup_zone, dropoff_zone, **lookup)


def silver_stream(
    bronze: DataFrame,
    zones: DataFrame,
    schema: StructType | str,
    keys: list[str],
    pickup: str = "tpep_pickup_datetime",
    dropoff: str = "tpep_dropoff_datetime",
    delay: str | None = None,
    salt: Column | None = None,
    pickup_zone: str | None = "PULocationID",
    dropoff_zone: str | None = "DOLocationID",
    **lookup,
) -> DataFrame:
    """:func:`silver_rows` with copies dropped by state, see :func:`dedup_stream` for what that costs.

    For a silver table that loses nothing and keeps no state, append the rows of
    :func:`silver_rows` with :func:`append_new`.
    """
    rows = silver_rows(bronze, zones, schema, pickup, dropoff, pickup_zone, dropoff_zone, **lookup)
    return dedup_stream(rows, keys, "pickup_ts", delay, salt)


def gold_stream(
    silver: DataFrame, delay: str, zone: str = "pickup_zone", ts: str = "pickup_ts", fare: str = "fare_amount"
) -> DataFrame:
    """Trips and average fare per zone and hour, each window once it is closed.

    A window closes when the newest time seen is more than the delay past its
    end. Rows that come later than that are not counted.
    """
    return gold_zone_hour_window(silver.withWatermark(ts, delay), zone, ts, fare)
