"""Mergeable sketches, stored per day and merged for any range of days without reading the data again.

A row holds the number of rows, an HLL sketch of each column whose distinct values are counted and a KLL sketch of each column
whose quantiles are asked. Sketches are built with partial aggregation, so a day with a third of all rows is one small sketch per
task, and merging sketches gives the sketch of the union. NULLs are in no sketch.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# log2 of the HLL registers: a standard error of about 1.04 / sqrt(4096) = 1.6 %.
LG_REGISTERS = 12


def sketched(df: DataFrame, by: list[str], distinct: list[str] = (), measured: list[str] = ()) -> DataFrame:
    """(by, n, distinct_<column>, values_<column>): one row for each group, to be stored."""
    return df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"),
        *[F.hll_sketch_agg(F.col(c).cast("string"), LG_REGISTERS).alias(f"distinct_{c}") for c in distinct],
        *[F.kll_sketch_agg_double(F.col(c).cast("double")).alias(f"values_{c}") for c in measured],
    )


def merged(sketches: DataFrame, by: list[str]) -> DataFrame:
    """Stored rows of :func:`sketched` united to fewer groups."""
    return sketches.groupBy(*by).agg(
        F.sum("n").alias("n"),
        *[F.hll_union_agg(c, F.lit(True)).alias(c) for c in sketches.columns if c.startswith("distinct_")],
        *[F.kll_merge_agg_double(c).alias(c) for c in sketches.columns if c.startswith("values_")],
    )


def estimates(sketches: DataFrame, quantiles: tuple[float, ...] = (0.5,)) -> DataFrame:
    """The estimates that the sketches hold: distinct_<column> as a number, <column>_p<percent> for each quantile."""
    out = []
    for c in sketches.columns:
        if c.startswith("distinct_"):
            out.append(F.hll_sketch_estimate(c).alias(c))
        elif c.startswith("values_"):
            name = c.removeprefix("values_")
            out += [F.kll_sketch_get_quantile_double(c, F.lit(q)).alias(f"{name}_p{q * 100:g}") for q in quantiles]
        else:
            out.append(F.col(c))
    return sketches.select(*out)
