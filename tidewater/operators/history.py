"""Table history as ordinary data: states by snapshot id, a commit log, and a run ledger.

A history folder holds ``commits`` (one row per commit) and either ``states``
(whole states, partitioned by snapshot_id) or ``changes`` (only the batch that
each snapshot merged, partitioned the same way). The first form is cheap to read,
the second one cheap to merge into and the one for large tables. Readers find
snapshots through the commit log only, and its row is written last, so a merge
that fails half way leaves nothing behind that a reader could see. Where the catalog has Iceberg tables,
:func:`rollback_table` and :func:`tidewater.operators.merge.merge_into_table`
do the same on the table itself.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidewater.operators.dedup import latest_per_key
from tidewater.operators.merge import merge_into_table, merge_upsert, no_null, require_unique
from tidewater.session import one_row, staged

LEDGER_SCHEMA = "table_name string, execution_date date, snapshot_id bigint, recorded_at timestamp"
Write = Callable[[DataFrame, str], None]
COMMIT_SCHEMA = "snapshot_id bigint, parent_id bigint, committed_at timestamp, seq bigint"


def _read_or_empty(spark: SparkSession, path: str, schema: str) -> DataFrame:
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


# -- ledger ------------------------------------------------------------------


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """The ledger; empty before the first run."""
    return _read_or_empty(spark, path, LEDGER_SCHEMA)


def record_snapshot(
    spark: SparkSession, path: str, table: str, execution_date: date, snapshot_id: int
) -> None:
    """Add a ledger row. Rows are never changed; several rows per date are normal."""
    row = one_row(spark, table_name=table, execution_date=execution_date).withColumns(
        {"snapshot_id": F.lit(snapshot_id).cast("bigint"), "recorded_at": F.current_timestamp()}
    )
    row.write.mode("append").parquet(path)


def snapshot_before(ledger: DataFrame, requests: DataFrame) -> DataFrame:
    """For each request (table_name, execution_date) the latest snapshot strictly before the date.

    Adds ``prev_date`` and ``snapshot_id``, both NULL if there is none. On one
    date the row recorded last wins.

    The ledger is first reduced to one row per table and date, and the requests
    to their distinct dates, both by partial aggregates. What a window then
    walks per table is bounded by the number of calendar days, whatever share
    of the ledger the table holds. The answers go back to the requests by an
    equality join.
    """
    by_day = ledger.groupBy("table_name", "execution_date").agg(
        F.max_by("snapshot_id", F.struct("recorded_at", "snapshot_id")).alias("snap")
    )
    asked = requests.select(
        "table_name", "execution_date", F.lit(None).cast("bigint").alias("snap"), F.lit(None).cast("date").alias("d")
    ).distinct()
    days = (
        by_day.withColumn("d", F.col("execution_date"))
        .unionByName(asked)
        .groupBy("table_name", "execution_date")
        .agg(F.max("snap").alias("snap"), F.max("d").alias("d"))
    )
    before = (
        Window.partitionBy("table_name")
        .orderBy("execution_date")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    answers = days.select(
        "table_name",
        "execution_date",
        F.last("d", ignorenulls=True).over(before).alias("prev_date"),
        F.last(F.when(F.col("d").isNotNull(), F.struct("snap")), ignorenulls=True).over(before).alias("s"),
    ).select("table_name", "execution_date", "prev_date", F.col("s.snap").alias("snapshot_id"))
    return requests.join(answers, ["table_name", "execution_date"], "left")


def get_snapshot_before(ledger: DataFrame, table: str, execution_date: date) -> int | None:
    """The answer for one table and date, as a number."""
    row = (
        ledger.filter((F.col("table_name") == table) & (F.col("execution_date") < F.lit(execution_date)))
        .orderBy(F.desc("execution_date"), F.desc("recorded_at"), F.desc("snapshot_id"))
        .select("snapshot_id")
        .first()
    )
    return None if row is None else row["snapshot_id"]


def ledger_stats(ledger: DataFrame) -> DataFrame:
    """Merges so far and time of the last one, per table."""
    return ledger.groupBy("table_name").agg(
        F.count(F.lit(1)).alias("merges"), F.max("recorded_at").alias("last_merge")
    )


# -- states ------------------------------------------------------------------


def snapshots(spark: SparkSession, root: str) -> DataFrame:
    """The commit log. Going back to a snapshot is a commit of its own."""
    return _read_or_empty(spark, f"{root}/commits", COMMIT_SCHEMA)


def latest_snapshot(commits: DataFrame) -> DataFrame:
    """One row: the snapshot id of the newest commit; no row without commits.

    The order of the commit log decides, as in :func:`current_snapshot_id`, not a clock; of a table's
    own log, which has no such order, the time of commit.
    """
    newest = ["seq"] if "seq" in commits.columns else ["committed_at", "snapshot_id"]
    return commits.orderBy(*map(F.desc, newest)).select("snapshot_id").limit(1)


def _head(spark: SparkSession, root: str) -> tuple[int | None, int, int]:
    """The current snapshot, the highest snapshot id and the number of commits so far."""
    row = snapshots(spark, root).agg(
        F.max_by("snapshot_id", "seq").alias("now"),
        F.coalesce(F.max("snapshot_id"), F.lit(0)).alias("top"),
        F.coalesce(F.max("seq"), F.lit(0)).alias("seq"),
    ).first()
    return row["now"], row["top"], row["seq"]


def current_snapshot_id(spark: SparkSession, root: str) -> int | None:
    """The snapshot readers see now."""
    return _head(spark, root)[0]


def _commit(spark: SparkSession, root: str, snapshot_id: int, seq: int, parent: int | None = None) -> None:
    row = spark.range(0, 1, 1, 1).select(
        F.lit(snapshot_id).cast("bigint").alias("snapshot_id"),
        F.lit(parent).cast("bigint").alias("parent_id"),
        F.current_timestamp().alias("committed_at"),
        F.lit(seq).cast("bigint").alias("seq"),
    )
    row.write.mode("append").parquet(f"{root}/commits")


def _overwrite(state: DataFrame, path: str) -> None:
    state.write.mode("overwrite").parquet(path)


def commit_state(spark: SparkSession, root: str, state: DataFrame, write: Write = _overwrite) -> int:
    """Write a whole state under a new snapshot id, then make it current.

    A table has one writer at a time. What a failed attempt left under the id is
    replaced by the next one. ``write`` may audit what it writes: if it raises, nothing has
    become visible.
    """
    _, top, seq = _head(spark, root)
    write(state, f"{root}/states/snapshot_id={top + 1}")
    _commit(spark, root, top + 1, seq + 1)
    return top + 1


def state_at(spark: SparkSession, root: str, snapshot_id: int) -> DataFrame:
    """The table as of a snapshot; reads that snapshot's files only."""
    return spark.read.parquet(f"{root}/states/snapshot_id={snapshot_id}")


def rollback(spark: SparkSession, root: str, snapshot_id: int) -> None:
    """Make an older snapshot current again. No data is rewritten."""
    _commit(spark, root, snapshot_id, _head(spark, root)[2] + 1)


def table_snapshots(spark: SparkSession, table: str) -> DataFrame:
    """The commits of an Iceberg table, from its metadata table."""
    return spark.table(f"{table}.snapshots").select("snapshot_id", "committed_at")


def rollback_table(spark: SparkSession, table: str, snapshot_id: int) -> None:
    """The same on an Iceberg table ``catalog.schema.name``."""
    catalog, name = table.split(".", 1)
    spark.sql(f"CALL {catalog}.system.rollback_to_snapshot('{name}', {int(snapshot_id)})")


def stateful_merge_table(
    spark: SparkSession, table: str, source: DataFrame, keys: list[str], execution_date: date, ledger_path: str
) -> int:
    """:func:`stateful_merge` on an Iceberg table, whose files are rewritten only where rows change.

    The first run creates the table with the source's columns.
    """
    if not spark.catalog.tableExists(table):
        source.limit(0).writeTo(table).using("iceberg").create()
    base = get_snapshot_before(read_ledger(spark, ledger_path), table, execution_date)
    if base is not None:
        rollback_table(spark, table, base)
    merge_into_table(table, source, keys)
    made = table_snapshots(spark, table).orderBy(F.desc("committed_at")).first()["snapshot_id"]
    record_snapshot(spark, ledger_path, table, execution_date, made)
    return made


def state_from_changes(log: DataFrame, keys: list[str], upto: int | None = None) -> DataFrame:
    """State of a change log whose rows carry ``snapshot_id``: the newest row per key up to a snapshot.

    Rows with a NULL in the key replace nothing and are all kept.
    """
    rows = log if upto is None else log.filter(F.col("snapshot_id") <= upto)
    keyed = latest_per_key(rows.filter(no_null(keys)), keys, ["snapshot_id"])
    return keyed.unionByName(rows.filter(~no_null(keys)))


def commit_changes(
    spark: SparkSession, root: str, batch: DataFrame, keys: list[str], parent: int | None
) -> int:
    """Write one batch of upserts on top of a snapshot, then make the result current."""
    require_unique(batch, keys)
    _, top, seq = _head(spark, root)
    batch.write.mode("overwrite").parquet(f"{root}/changes/snapshot_id={top + 1}")
    _commit(spark, root, top + 1, seq + 1, parent)
    return top + 1


def lineage(spark: SparkSession, root: str, snapshot_id: int) -> list[int]:
    """A snapshot and those it was built on, newest first.

    One number pair per commit comes to the driver, as the file list of a table does.
    """
    parents = dict(
        snapshots(spark, root).groupBy("snapshot_id").agg(F.max("parent_id").alias("parent_id")).collect()
    )
    line, at = [], snapshot_id
    while at is not None:
        line.append(at)
        at = parents.get(at)
    return line


def state_at_changes(spark: SparkSession, root: str, keys: list[str], snapshot_id: int) -> DataFrame:
    """The table as of a snapshot, from the batches it was built on; other partitions are not read."""
    log = spark.read.parquet(f"{root}/changes").filter(F.col("snapshot_id").isin(lineage(spark, root, snapshot_id)))
    return state_from_changes(log, keys).drop("snapshot_id")


def _base(spark: SparkSession, root: str, table: str, execution_date: date, ledger_path: str) -> int | None:
    before = get_snapshot_before(read_ledger(spark, ledger_path), table, execution_date)
    return current_snapshot_id(spark, root) if before is None else before


def stateful_merge_changes(
    spark: SparkSession, root: str, source: DataFrame, keys: list[str], table: str,
    execution_date: date, ledger_path: str,
) -> int:
    """:func:`stateful_merge` that writes the batch only, whatever the size of the table."""
    base = _base(spark, root, table, execution_date, ledger_path)
    snapshot_id = commit_changes(spark, root, staged(source, "source"), keys, base)
    record_snapshot(spark, ledger_path, table, execution_date, snapshot_id)
    return snapshot_id


def stateful_merge(
    spark: SparkSession, root: str, source: DataFrame, keys: list[str], table: str,
    execution_date: date, ledger_path: str, write: Write = _overwrite,
) -> int:
    """Merge into the snapshot before the date, and record the new snapshot.

    A backfill for an older date thereby starts from what the table was before
    that date; without an earlier one it starts from the current state. Nothing
    becomes visible before the merge is written, so if it fails the table and the
    ledger are as before. ``write`` is that of :func:`commit_state`.
    """
    base = _base(spark, root, table, execution_date, ledger_path)
    batch = staged(source, "source")
    target = batch.limit(0) if base is None else state_at(spark, root, base)
    snapshot_id = commit_state(spark, root, merge_upsert(target, batch, keys), write)
    record_snapshot(spark, ledger_path, table, execution_date, snapshot_id)
    return snapshot_id
