"""Connected components of links, by alternating star steps of DataFrame joins."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from tidewater.llm.staging import staged


def _written(edges: DataFrame) -> tuple[DataFrame, dict]:
    """The edges in the shared folder, with their number and a sum of hashes that tells them from other edges."""
    seen = Observation()
    total = F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
    written = staged(edges.observe(seen, F.count(F.lit(1)).alias("n"), total.alias("total")), "star-edges")
    return written, seen.get


def components(links: DataFrame) -> DataFrame:
    """(node, label) for each node of the links (a, b) that is not the smallest of its component.

    The label is the component's smallest node. A large-star step hangs larger neighbours
    under a node's smallest neighbour, a small-star step the smaller ones; after about the logarithm of
    the longest path nothing changes. Each step's edges are written to the shared folder, so
    lineage stays short. Links with a null end are left out.
    """
    a, b = F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    named = links.where(F.col("a").isNotNull() & F.col("b").isNotNull() & (F.col("a") != F.col("b")))
    edges, mark = _written(named.select(a, b).distinct())
    while mark["n"]:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("of"), F.least("a", "m").alias("m"))
        large = both.join(least, F.col("a") == F.col("of")).where(F.col("b") > F.col("a"))
        large = large.where(F.col("b") != F.col("m")).select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("of"), "m")
        small = large.join(least, F.col("a") == F.col("of")).select(
            F.explode(F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b"))))
        )
        before = mark
        edges, mark = _written(small.select("col.*").where(F.col("a") != F.col("b")).distinct())
        if mark == before:
            break
    return edges.select(F.col("a").alias("node"), F.col("b").alias("label"))
