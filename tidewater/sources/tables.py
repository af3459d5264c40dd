"""Catalog tables and tables of another database."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def read_table(spark: SparkSession, name: str) -> DataFrame:
    """Batch scan of a catalog table."""
    return spark.table(name)


def read_table_stream(
    spark: SparkSession, name: str | None = None, path: str | None = None,
    schema: StructType | str | None = None, files_per_batch: int | None = None,
) -> DataFrame:
    """A table as a stream: by catalog name, or the Parquet folder at ``path``."""
    reader = spark.readStream
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    if name:
        return reader.table(name)
    return reader.schema(schema).parquet(path)


def read_jdbc(
    spark: SparkSession, url: str, table: str, split_on: str | None = None,
    bounds: tuple[int, int] | None = None, partitions: int | None = None, **properties: str,
) -> DataFrame:
    """A table of another database; with a split column it is read in parallel ranges."""
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", table)
    if split_on:
        reader = (
            reader.option("partitionColumn", split_on)
            .option("lowerBound", bounds[0])
            .option("upperBound", bounds[1])
            .option("numPartitions", partitions)
        )
    return reader.options(**properties).load()
