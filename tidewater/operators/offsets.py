"""Consumed log offsets as sets of intervals.

A set has a row (topic, partition, first, last) for each run of consumed offsets, both ends included. Whether
a record is already stored is then a range test on a small table, and the stored records are not
read. Runs are found in chunks of CHUNK neighbouring offsets, each a bounded group however many records one
partition of the log has; only runs that touch the edge of a chunk are compared with those of the next one.
Offsets that are NULL, or lie in a NULL topic or partition, are in no set: their records count as new.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidewater.operators.merge import no_null

# Neighbouring offsets that are looked at in one group.
CHUNK = 65_536
LOG = ("topic", "partition")
SCHEMA = "topic string, partition int, first bigint, last bigint, batch_id bigint"


def _runs(pieces: DataFrame, by: list[str]) -> DataFrame:
    """Pieces (by, first, last) that touch or overlap, as one."""
    in_order = Window.partitionBy(*by).orderBy("first", "last")
    before = F.max("last").over(in_order.rowsBetween(Window.unboundedPreceding, -1))
    begins = F.when(before.isNull() | (F.col("first") > before + 1), 1).otherwise(0)
    run = F.sum("begins").over(in_order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    numbered = pieces.select("*", begins.alias("begins")).select(*by, "first", "last", run.alias("run"))
    return numbered.groupBy(*by, "run").agg(F.min("first").alias("first"), F.max("last").alias("last")).drop("run")


def _united(pieces: DataFrame, log: list[str]) -> DataFrame:
    """Runs of pieces that each lie in one chunk: within chunks first, then over their edges."""
    chunk = F.floor(F.col("first") / CHUNK)
    inner = _runs(pieces.select(*log, chunk.alias("chunk"), "first", "last"), [*log, "chunk"])
    edge = (F.col("first") == F.col("chunk") * CHUNK) | (F.col("last") == (F.col("chunk") + 1) * CHUNK - 1)
    alone = inner.filter(~edge).select(*log, "first", "last")
    return alone.unionByName(_runs(inner.filter(edge).select(*log, "first", "last"), log))


def _pieces(intervals: DataFrame, log: list[str]) -> DataFrame:
    """Intervals cut at the edges of chunks."""
    low, high = F.floor(F.col("first") / CHUNK), F.floor(F.col("last") / CHUNK)
    cut = intervals.select(*log, "first", "last", F.explode(F.sequence(low, high)).alias("chunk"))
    first = F.greatest("first", F.col("chunk") * CHUNK)
    last = F.least("last", (F.col("chunk") + 1) * CHUNK - 1)
    return cut.select(*log, first.alias("first"), last.alias("last"))


def intervals_of(records: DataFrame, log: tuple[str, ...] = LOG, offset: str = "offset") -> DataFrame:
    """The set of the records' offsets. Repeated offsets are reduced in each task first."""
    by = list(log)
    points = records.filter(no_null([*by, offset])).select(*by, F.col(offset).alias("first")).distinct()
    return _united(points.select("*", F.col("first").alias("last")), by)


def union_intervals(*sets: DataFrame, log: tuple[str, ...] = LOG) -> DataFrame:
    """The offsets of any of the sets."""
    by = list(log)
    stacked = sets[0].select(*by, "first", "last")
    for other in sets[1:]:
        stacked = stacked.unionByName(other.select(*by, "first", "last"))
    return _united(_pieces(stacked, by), by)


def gaps(intervals: DataFrame, log: tuple[str, ...] = LOG) -> DataFrame:
    """The runs of offsets between the first and the last consumed one that are missing.

    One row per run of the set passes through the group of its partition of the log, in order and without
    being held.
    """
    before = F.lag("last").over(Window.partitionBy(*log).orderBy("first"))
    holes = intervals.select(*log, (before + 1).alias("first"), (F.col("first") - 1).alias("last"))
    return holes.filter(F.col("first") <= F.col("last"))


def not_consumed(
    batch: DataFrame, intervals: DataFrame, log: tuple[str, ...] = LOG, offset: str = "offset"
) -> DataFrame:
    """Records of a batch whose offset is in no interval.

    Intervals and the batch's distinct offsets are stacked by chunk; behind each interval's start its end is carried
    along, so that every offset meets one number. The batch's rows are then kept by an equality join.
    """
    by = list(log)
    chunk = F.floor(F.col("first") / CHUNK).alias("chunk")
    asked = batch.filter(no_null([*by, offset])).select(*by, F.col(offset).alias("first")).distinct()
    # Only chunks that the batch has offsets in are looked at.
    chunks = asked.select(*by, chunk).distinct()
    held = _pieces(intervals, by).select(*by, chunk, "first", "last").join(chunks, [*by, "chunk"], "left_semi")
    points = asked.select(*by, chunk, "first", F.lit(None).cast("bigint").alias("last"))
    up_to = Window.partitionBy(*by, "chunk").orderBy("first", F.asc_nulls_last("last"))
    reach = F.max("last").over(up_to.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    marked = held.unionByName(points).select("*", reach.alias("reach")).filter(F.col("last").isNull())
    known = marked.filter(F.col("first") <= F.col("reach")).select(*by, F.col("first").alias(offset))
    return batch.join(known, [*by, offset], "left_anti")


def read_offsets(spark: SparkSession, path: str) -> DataFrame:
    """The consumed offsets of all batches as one set; empty before the first one."""
    try:
        stored = spark.read.schema(SCHEMA).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        stored = spark.createDataFrame([], SCHEMA)
    return union_intervals(stored)


def append_consumed(records: DataFrame, bronze: str, offsets: str, batch_id: int) -> None:
    """Store those records of a batch that no earlier batch has, then the batch's offsets.

    The records replace the partition ``batch_id`` of bronze and the offsets that of their own table, so a
    batch that died in between is run again under its number and leaves no second copy; what other batches
    stored is not touched. Copies of a record within the batch are stored once.
    """
    spark = records.sparkSession
    earlier = _others(spark, offsets, batch_id)
    by = [*LOG, "offset"]
    # What is already stored goes first: the records are shuffled once, and their copies then lie together.
    fresh = not_consumed(records.filter(no_null(by)), earlier).dropDuplicates(by)
    _replace(fresh.unionByName(records.filter(~no_null(by))), bronze, batch_id)
    written = spark.read.schema(records.schema).parquet(_batch(bronze, batch_id))
    _replace(intervals_of(written).select(*LOG, "first", "last"), offsets, batch_id)


def _others(spark: SparkSession, path: str, batch_id: int) -> DataFrame:
    try:
        stored = spark.read.schema(SCHEMA).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        stored = spark.createDataFrame([], SCHEMA)
    return stored.filter(F.col("batch_id") != batch_id)


def _replace(rows: DataFrame, path: str, batch_id: int) -> None:
    rows.write.mode("overwrite").parquet(_batch(path, batch_id))


def _batch(path: str, batch_id: int) -> str:
    return f"{path}/batch_id={int(batch_id)}"
