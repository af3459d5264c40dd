"""File sources: Parquet, CSV, raw objects, and discovery of files not seen before."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

MANIFEST_SCHEMA = "path string, file_name string, processed_at timestamp"


def read_parquet(spark: SparkSession, *paths: str, schema: StructType | str | None = None) -> DataFrame:
    """One file, a dataset folder, or a glob of either."""
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.parquet(*paths)


def read_csv_dir(
    spark: SparkSession, path: str, schema: StructType | str | None = None
) -> DataFrame:
    """CSV files with a header line. Without a schema Spark reads the data once more to infer one."""
    reader = spark.read.option("header", True)
    reader = reader.schema(schema) if schema is not None else reader.option("inferSchema", True)
    return reader.csv(path)


def with_source_file(df: DataFrame) -> DataFrame:
    """Name of the file each row came from.

    It is taken from the scan's own metadata column, so it has to be asked for
    before the first shuffle; a later deduplication then keeps it.
    """
    return df.withColumn("source_file", F.col("_metadata.file_name"))


def with_source_path(df: DataFrame) -> DataFrame:
    """Full path of the file each row came from; like the name it is taken at the scan."""
    return df.withColumn("source_path", F.col("_metadata.file_path"))


def list_files(spark: SparkSession, glob: str) -> DataFrame:
    """Name, path, length and time of the files under a glob; contents are not read."""
    return spark.read.format("binaryFile").load(glob).select(
        F.element_at(F.split("path", "/"), -1).alias("file_name"),
        "path",
        "length",
        F.col("modificationTime").alias("modified_at"),
    )


def new_files(inbox: DataFrame, manifest: DataFrame, key: str = "path") -> DataFrame:
    """Inbox files that the manifest does not list. Files of equal name in different folders are different."""
    return inbox.join(manifest.select(key), key, "left_anti")


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """The manifest; empty before the first run wrote one."""
    try:
        return spark.read.schema(MANIFEST_SCHEMA).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], MANIFEST_SCHEMA)


def mark_processed(files: DataFrame, manifest_path: str) -> None:
    """Add files (path, file_name) to the manifest, after their output has been written."""
    done = files.select("path", "file_name", F.current_timestamp().alias("processed_at"))
    done.coalesce(1).write.mode("append").parquet(manifest_path)


def read_objects(spark: SparkSession, glob: str) -> DataFrame:
    """Whole binary objects, one row each: path, modificationTime, length, content."""
    return spark.read.format("binaryFile").load(glob)


def read_texts(spark: SparkSession, glob: str) -> DataFrame:
    """Whole text objects, one row each, with the file's path."""
    return spark.read.text(glob, wholetext=True).select(
        F.col("_metadata.file_path").alias("path"), F.col("value").alias("text")
    )


def take_first(df: DataFrame, n: int, *order: str) -> DataFrame:
    """The first n rows in a total order, so that a rerun takes the same rows."""
    return df.orderBy(*order).limit(n)


def keep_ids(df: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """Rows whose key is in the list of ids."""
    return df.join(ids.select(key), key, "left_semi")
