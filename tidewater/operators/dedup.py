"""Deduplication, latest row per key, and duplicate reports.

Picking one row per key is written as ``row_number() = 1``. Spark then keeps
one row per key in each map task before it shuffles (WindowGroupLimit), so a key
with very many copies reaches its reducer as one row per task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewater.session import staged_by_small_tasks


def _first_row(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("__place", place).filter("__place = 1").drop("__place")


def dedup(df: DataFrame, keys: list[str], order: list[str | Column] | None = None) -> DataFrame:
    """One row per key; NULL keys are equal to each other.

    The survivor is the first row by ``order``; without an order any row may
    survive. The result is repeatable only when the order leaves no ties.
    """
    if order is None:
        return df.dropDuplicates(keys)
    return _first_row(df, keys, [F.col(o) if isinstance(o, str) else o for o in order])


def latest_per_key(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The row of each key that is largest by the order columns, compared left to right."""
    return _first_row(df, keys, [F.col(o).desc() for o in order])


def dedup_against(df: DataFrame, target: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose key the target does not hold yet; a NULL matches a NULL, as in :func:`dedup`."""
    asked = df.select(*[F.col(k).alias(f"__a_{k}") for k in keys]).distinct()
    held = target.select(*[F.col(k).alias(f"__t_{k}") for k in keys])

    def same(left: str, right: str) -> Column:
        cond = F.lit(True)
        for k in keys:
            cond = cond & F.col(f"{left}{k}").eqNullSafe(F.col(f"{right}{k}"))
        return cond

    # The target is cut down to the batch's keys where it lies, when Spark can broadcast these.
    seen = held.join(asked, same("__t_", "__a_"), "left_semi").distinct()
    return df.join(seen, same("", "__t_"), "left_anti")


def _per_key(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))


def dedup_report(df: DataFrame, keys: list[str]) -> DataFrame:
    """One row: rows before, rows after deduplication, rows removed. NULL keys form a group."""
    counts = _per_key(df, keys).agg(F.coalesce(F.sum("n"), F.lit(0)).alias("before_n"), F.count(F.lit(1)).alias("after_n"))
    return staged_by_small_tasks(counts, "report").withColumn("removed", F.col("before_n") - F.col("after_n"))


def over(df: DataFrame, keys: list[str], k: int = 1) -> DataFrame:
    """:func:`keys_over` as a plan, for a caller that only counts the keys."""
    return _per_key(df, keys).filter(F.col("n") > k)


def keys_over(df: DataFrame, keys: list[str], k: int = 1) -> DataFrame:
    """Keys that occur in more than k rows, with their number of rows. They are staged."""
    return staged_by_small_tasks(over(df, keys, k), "repeated-keys")


def count_duplicates(df: DataFrame, keys: list[str]) -> DataFrame:
    """One row: how many key values occur more than once."""
    return staged_by_small_tasks(over(df, keys).agg(F.count(F.lit(1)).alias("dup_keys")), "repeated-keys")
