"""Event-log records: key, value, topic, partition, offset, timestamp.

Kafka delivers this shape; any DataFrame with these columns can stand in.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_event_stream(
    spark: SparkSession, servers: str, pattern: str, start: str = "earliest", **options: str
) -> DataFrame:
    """Unbounded read of every topic whose name matches a pattern."""
    return (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribePattern", pattern)
        .option("startingOffsets", start)
        .options(**options)
        .load()
    )


def read_event_log(
    spark: SparkSession, servers: str, topics: str | list[str], start: str = "earliest", **options: str
) -> DataFrame:
    """Bounded read of one topic or a list, from the start offsets to the latest ones."""
    names = topics if isinstance(topics, str) else ",".join(topics)
    return (
        spark.read.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", names)
        .option("startingOffsets", start)
        .options(**options)
        .load()
    )


def with_record_meta(df: DataFrame, key: bool = False) -> DataFrame:
    """Payload as text beside the record's place in the log."""
    head = [F.col("key").cast("string").alias("key")] if key else []
    return df.select(
        *head,
        F.col("value").cast("string").alias("value"),
        F.col("timestamp").alias("kafka_time"),
        "topic",
        "partition",
        "offset",
    )


def in_log_order(df: DataFrame) -> DataFrame:
    """Rows by partition, then offset."""
    return df.orderBy("partition", "offset")
