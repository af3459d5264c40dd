"""Batch sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidewater.functions import fingerprint


def append(df: DataFrame, path: str) -> None:
    """Add the rows to a Parquet dataset."""
    df.write.mode("append").parquet(path)


def append_nonempty(df: DataFrame, path: str) -> bool:
    """Add the rows; says whether there were any.

    The plan runs once and its rows are counted as they are written. Without rows the
    dataset gains no row, at most a file that holds its schema.
    """
    seen = Observation()
    append(df.observe(seen, F.count(F.lit(1)).alias("n")), path)
    return seen.get["n"] > 0


def create_or_append(df: DataFrame, table: str, path: str | None = None, fmt: str = "parquet") -> None:
    """Create the catalog table on the first run, add to it afterwards.

    Columns are matched by name; a batch with other columns than the table is refused.
    """
    if df.sparkSession.catalog.tableExists(table):
        columns = df.sparkSession.table(table).columns
        if sorted(columns) != sorted(df.columns):
            raise ValueError(f"{table} has the columns {columns}, the batch has {df.columns}")
        df.select(*columns).write.mode("append").insertInto(table)
        return
    writer = df.write.format(fmt)
    (writer.option("path", path) if path else writer).saveAsTable(table)


def overwrite(df: DataFrame, path: str) -> None:
    """Replace a dataset. The rows may not be read from the same path."""
    df.write.mode("overwrite").parquet(path)


def overwrite_table(df: DataFrame, table: str, path: str | None = None, fmt: str = "parquet") -> None:
    """Replace a catalog table."""
    writer = df.write.format(fmt).mode("overwrite")
    (writer.option("path", path) if path else writer).saveAsTable(table)


def overwrite_partitions(df: DataFrame, path: str, *cols: str) -> None:
    """Replace only the partitions that the rows belong to; others stay.

    The rebalance hint brings each partition's rows together, so that a
    partition does not end up as one small file per task, and lets AQE split a
    partition that is much larger than the rest.
    """
    (
        df.hint("rebalance", *cols)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*cols)
        .parquet(path)
    )


def create_day_table(
    spark: SparkSession, table: str, schema: StructType, ts: str, path: str | None = None,
    fmt: str = "parquet",
) -> None:
    """Create an empty table partitioned by the day of a timestamp column.

    File formats without partition transforms get a derived ``<ts>_day`` date
    column; an Iceberg table gets ``days(ts)``.
    """
    if fmt == "iceberg":
        empty = spark.createDataFrame([], schema)
        empty.writeTo(table).using(fmt).partitionedBy(F.partitioning.days(ts)).create()
        return
    empty = with_day(spark.createDataFrame([], schema), ts)
    writer = empty.write.format(fmt).partitionBy(f"{ts}_day")
    (writer.option("path", path) if path else writer).saveAsTable(table)


def with_day(df: DataFrame, ts: str) -> DataFrame:
    """The partition column of :func:`create_day_table`."""
    return df.withColumn(f"{ts}_day", F.to_date(ts))


def land_objects(objects: DataFrame, path: str, content: str = "content") -> None:
    """Store raw objects in Parquet beside a row of facts about them.

    The content hash is computed as the bytes are written, so it costs no
    second read.
    """
    objects.withColumn("source_fingerprint", fingerprint(content)).write.mode("append").parquet(path)
