"""Reconciliation by checksums: two tables are compared bucket by bucket, and row by row only where buckets differ.

A checksum is the number of a bucket's rows and the sums of two 64-bit hashes of each row (key and values), so it does not
depend on the order of rows and is a plain aggregate with partial sums in each task. The comparison goes down a
tree: buckets of the key, then finer buckets within those that differ, then the rows of the finer ones. Where a
table is partitioned by the bucket (see ``plans.bucketed``) only the partitions that differ are read again, and
where checksums were stored the first pass over that side falls away.

Rows count as often as they occur, NULLs are values of their own, and NULL keys are compared like others.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.operators.cdc import reconcile_rows

# Finer buckets within a bucket.
FINE = 256


def _hash(columns: list[str], salt: int) -> Column:
    """A 64-bit hash that tells NULL from the empty string and one column from the next."""
    parts: list[Column] = [F.lit(salt)]
    for c in columns:
        parts += [F.col(c).isNull(), F.col(c).cast("string")]
    return F.xxhash64(*parts)


def _bucket(keys: list[str], buckets: int) -> Column:
    """As the partition column of a bucketed table."""
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def _fine(keys: list[str], fine: int) -> Column:
    """A finer bucket, by a hash that does not follow from the bucket."""
    return F.pmod(_hash(keys, 1), F.lit(fine)).cast("int")


def checksums(df: DataFrame, keys: list[str], values: list[str], by: dict[str, Column]) -> DataFrame:
    """(by, n, sum_1, sum_2) of the rows of each bucket."""
    row = [*keys, *values]
    hashed = df.select(*[c.alias(n) for n, c in by.items()], *[_hash(row, s).alias(f"h_{s}") for s in (2, 3)])
    return hashed.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"),
        *[F.sum(F.col(f"h_{s}").cast("decimal(38,0)")).alias(f"sum_{i}") for i, s in enumerate((2, 3), 1)],
    )


def bucket_checksums(df: DataFrame, keys: list[str], values: list[str], buckets: int) -> DataFrame:
    """The checksums of a table's buckets, small enough to be stored beside it."""
    return checksums(df, keys, values, {"bucket": _bucket(keys, buckets)})


def differing(source: DataFrame, mirror: DataFrame) -> DataFrame:
    """Buckets whose checksums differ, or that only one side has."""
    by = [c for c in source.columns if c not in ("n", "sum_1", "sum_2")]
    signed = [F.col(c).cast("decimal(38,0)") for c in ("n", "sum_1", "sum_2")]
    names = ("n", "sum_1", "sum_2")
    stacked = source.select(*by, *[c.alias(n) for c, n in zip(signed, names)]).unionByName(
        mirror.select(*by, *[(-c).alias(n) for c, n in zip(signed, names)])
    )
    sums = stacked.groupBy(*by).agg(*[F.sum(n).alias(n) for n in names])
    return sums.filter(" or ".join(f"{n} <> 0" for n in names)).select(*by)


def _within(df: DataFrame, keys: list[str], buckets: int, only: list[int]) -> DataFrame:
    """The rows of some buckets, by partition where the table has the bucket as a column."""
    stored = f"bucket_of_{buckets}"
    return df.filter((F.col(stored) if stored in df.columns else _bucket(keys, buckets)).isin(only))


def reconcile_tree(
    source: DataFrame,
    mirror: DataFrame,
    keys: list[str],
    values: list[str],
    buckets: int = 1024,
    fine: int = FINE,
    source_sums: DataFrame | None = None,
    mirror_sums: DataFrame | None = None,
) -> DataFrame:
    """Keys on which source and mirror differ, as :func:`reconcile_rows` gives them.

    Either side's :func:`bucket_checksums` may be given instead of being computed. The numbers of the buckets that differ, at
    most ``buckets``, come to the driver; finer buckets and rows do not.
    """
    source_sums = bucket_checksums(source, keys, values, buckets) if source_sums is None else source_sums
    mirror_sums = bucket_checksums(mirror, keys, values, buckets) if mirror_sums is None else mirror_sums
    only = sorted(r["bucket"] for r in differing(source_sums, mirror_sums).collect())
    sides = [_within(df, keys, buckets, only).select(*keys, *values) for df in (source, mirror)]
    by = {"bucket": _bucket(keys, buckets), "fine": _fine(keys, fine)}
    # As many rows as there are finer buckets in the buckets that differ.
    odd = differing(*[checksums(side, keys, values, by) for side in sides])
    rows = [side.select("*", *[c.alias(f"__{n}") for n, c in by.items()]) for side in sides]
    odd = odd.select(F.col("bucket").alias("__bucket"), F.col("fine").alias("__fine"))
    kept = [r.join(odd, ["__bucket", "__fine"], "left_semi").drop("__bucket", "__fine") for r in rows]
    return reconcile_rows(*kept, keys, values)
