"""Merge, upsert, insert-if-absent, keyed update and delete, as plain joins.

Each function returns the new state of a target. A merge is one full outer join, in
which either side is read and shuffled once. Updates and inserts are left and anti
joins, whose target stays where it is when Spark can broadcast the changes.

A NULL in a key matches nothing, as in SQL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.operators.dedup import dedup, keys_over


def no_null(keys: list[str]) -> Column:
    """Whether every key column holds a value."""
    cond = F.col(keys[0]).isNotNull()
    for k in keys[1:]:
        cond = cond & F.col(k).isNotNull()
    return cond


def require_unique(df: DataFrame, keys: list[str], what: str = "merge source") -> None:
    """Raise if a key repeats. Reads the key columns and brings one row to the driver."""
    twice = keys_over(df.filter(no_null(keys)), keys).limit(1).collect()
    if twice:
        raise ValueError(f"{what} repeats the key {[twice[0][k] for k in keys]} of {keys}")


def _hits(target: DataFrame, source: DataFrame, keys: list[str]) -> DataFrame:
    return target.select(*keys).join(source.select(*keys), keys, "left_semi").distinct()


def _matched(target: DataFrame, source: DataFrame, keys: list[str]) -> tuple[DataFrame, Column]:
    """Target rows beside the source row of the same key, packed in ``__s``."""
    side = source.select(
        *[F.col(k).alias(f"__k_{k}") for k in keys], F.struct(*source.columns).alias("__s")
    )
    cond = F.col(keys[0]) == F.col(f"__k_{keys[0]}")
    for k in keys[1:]:
        cond = cond & (F.col(k) == F.col(f"__k_{k}"))
    return target.join(side, cond, "left"), F.col("__s").isNotNull()


def _merged(target: DataFrame, source: DataFrame, keys: list[str]) -> tuple[DataFrame, Column, Column]:
    """All rows of both sides, packed in ``__t`` and ``__s``, and whether a target or source row is there."""
    left = target.select(*[F.col(k).alias(f"__l_{k}") for k in keys], F.struct(*target.columns).alias("__t"))
    right = source.select(*[F.col(k).alias(f"__r_{k}") for k in keys], F.struct(*source.columns).alias("__s"))
    cond = F.col(f"__l_{keys[0]}") == F.col(f"__r_{keys[0]}")
    for k in keys[1:]:
        cond = cond & (F.col(f"__l_{k}") == F.col(f"__r_{k}"))
    return left.join(right, cond, "full"), F.col("__t").isNotNull(), F.col("__s").isNotNull()


def classify_merge(target: DataFrame, source: DataFrame, keys: list[str]) -> DataFrame:
    """Key values with a class: matched, target_only or source_only. A NULL in a key never matches."""

    def side(df: DataFrame, name: str) -> DataFrame:
        apart = F.when(~no_null(keys), F.lit(name))
        return df.select(*keys, F.lit(name).alias("side"), apart.alias("apart"))

    sides = side(target, "target_only").unionByName(side(source, "source_only"))
    low, high = F.min("side"), F.max("side")
    return (
        sides.groupBy(*keys, "apart")
        .agg(F.when(low == high, low).otherwise("matched").alias("merge_class"))
        .drop("apart")
    )


def merge_upsert(target: DataFrame, source: DataFrame, keys: list[str], check: bool = True) -> DataFrame:
    """Source rows replace target rows of the same key; the others are added.

    A source that repeats a key is refused, since it does not say which row
    should win. ``check=False`` is for sources known to be unique.
    """
    if check:
        require_unique(source, keys)
    joined, old, new = _merged(target, source, keys)
    return joined.select(*[F.when(new, F.col(f"__s.{c}")).otherwise(F.col(f"__t.{c}")).alias(c) for c in target.columns])


def merge_cdc(
    target: DataFrame,
    changes: DataFrame,
    key: str,
    values: dict[str, str],
    change_key: str = "entity_id",
    op: str = "op",
    deletes: tuple[str, ...] = ("d",),
    upserts: tuple[str, ...] = ("c", "u", "r"),
    check: bool = True,
) -> DataFrame:
    """Apply change events, one per key, to a current-state table.

    ``values`` maps target columns to change columns. A delete of a key that is
    not there does nothing, and other kinds of events leave a row as it is.
    ``check=False`` is for events already reduced to one per key.
    """
    batch = changes.filter(F.col(change_key).isNotNull()).select(
        F.col(change_key).alias(key), F.col(op).alias("__op"), *[F.col(c).alias(t) for t, c in values.items()]
    )
    if check:
        require_unique(batch, [key], "change batch")
    joined, old, _ = _merged(target, batch, [key])
    kind = F.coalesce(F.col("__s.__op"), F.lit(""))
    puts = kind.isin(*upserts)
    named = {key, *values}
    return joined.filter((old & ~kind.isin(*deletes)) | (~old & puts)).select(
        *[
            F.when(puts, F.col(f"__s.{c}")).otherwise(F.col(f"__t.{c}")).alias(c) if c in named else F.col(f"__t.{c}")
            for c in target.columns
        ]
    )


def insert_if_absent(
    target: DataFrame, source: DataFrame, keys: list[str], order: list[str] | None = None
) -> DataFrame:
    """Add the source rows whose key is new; existing rows win and are not changed."""
    return target.unionByName(absent_rows(target, source, keys, order).select(*target.columns))


def absent_rows(
    target: DataFrame, source: DataFrame, keys: list[str], order: list[str] | None = None
) -> DataFrame:
    """The rows :func:`insert_if_absent` would add: one per new key, the first by ``order``.

    A NULL key conflicts with nothing, so those rows are all added.
    """
    keyed = source.filter(no_null(keys))
    new = keyed.join(_hits(target, keyed, keys), keys, "left_anti")
    unkeyed = source.filter(~no_null(keys))
    return dedup(new, keys, order).select(*source.columns).unionByName(unkeyed)


def update_by_key(target: DataFrame, patch: DataFrame, key: str, check: bool = True) -> DataFrame:
    """Set the patch's columns on target rows of the same key; rows without a patch stay."""
    if check:
        require_unique(patch, [key], "patch")
    joined, hit = _matched(target, patch, [key])
    return joined.select(
        *[
            F.when(hit, F.col(f"__s.{c}")).otherwise(F.col(c)).alias(c)
            if c in patch.columns and c != key
            else F.col(c)
            for c in target.columns
        ]
    )


def delete_where(df: DataFrame, predicate: Column) -> DataFrame:
    """Rows for which the predicate is not true; an unknown result keeps the row."""
    return df.filter(~F.coalesce(predicate, F.lit(False)))


def insert_rows(target: DataFrame, rows: list[dict]) -> DataFrame:
    """Add literal rows; columns they leave out are NULL."""
    extra = target.sparkSession.createDataFrame(
        [tuple(r.get(c) for c in target.columns) for r in rows], target.schema
    )
    return target.unionByName(extra)


def merge_into_table(table: str, source: DataFrame, keys: list[str]) -> None:
    """The upsert as ``MERGE INTO``, for catalogs whose tables support it."""
    on = " AND ".join(f"t.`{k}` = s.`{k}`" for k in keys)
    source.sparkSession.sql(
        f"MERGE INTO {table} AS t USING {{source}} AS s ON {on} "
        "WHEN MATCHED THEN UPDATE SET * WHEN NOT MATCHED THEN INSERT *",
        source=source,
    )
