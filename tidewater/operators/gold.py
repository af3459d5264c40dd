"""Aggregates, counts, rates, previews and metric rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.functions import ratio


def gold_zone_hour_window(
    df: DataFrame, zone: str = "pickup_zone", ts: str = "pickup_ts", fare: str = "fare_amount"
) -> DataFrame:
    """Trips and average fare per zone and hour, by tumbling window. Rows without a time drop out."""
    return (
        df.groupBy(F.window(ts, "1 hour").alias("w"), zone)
        .agg(F.count(F.lit(1)).alias("trip_count"), F.avg(fare).alias("avg_fare"))
        .select(zone, F.col("w.start").alias("pickup_hour"), "trip_count", "avg_fare")
    )


def gold_zone_period(
    df: DataFrame, zone: str = "pickup_zone_name", ts: str = "pickup_ts", fare: str = "fare_amount",
    distance: str = "trip_distance", unit: str = "hour",
) -> DataFrame:
    """Trips, average fare and average distance per zone and hour (or other unit).

    Rows without a time form a group of their own.
    """
    return df.groupBy(zone, F.date_trunc(unit, ts).alias(f"pickup_{unit}")).agg(
        F.count(F.lit(1)).alias("trips_count"),
        F.avg(fare).alias("avg_fare_amount"),
        F.avg(distance).alias("avg_trip_distance"),
    )


def row_count(df: DataFrame) -> DataFrame:
    """One row: n."""
    return df.agg(F.count(F.lit(1)).alias("n"))


def count_by(df: DataFrame, *cols: str) -> DataFrame:
    """Rows per value."""
    return df.groupBy(*cols).agg(F.count(F.lit(1)).alias("cnt"))


def null_rates(df: DataFrame, cols: list[str]) -> DataFrame:
    """One row with the share of NULLs per column, in one pass; 0.0 for an empty table."""
    return df.agg(
        *[
            F.coalesce(ratio(F.count_if(F.col(c).isNull()), F.count(F.lit(1))), F.lit(0.0)).alias(
                f"rate_{c}"
            )
            for c in cols
        ]
    )


def distinct_count(df: DataFrame, col: str, name: str | None = None) -> DataFrame:
    """One row: number of distinct non-NULL values."""
    return df.agg(F.count_distinct(col).alias(name or f"distinct_{col}"))


def _share(part: Column, whole: Column) -> Column:
    return ratio(F.lit(100.0) * part, whole)


def pct_where(df: DataFrame, cond: Column, name: str = "pct") -> DataFrame:
    """One row: percent of rows that meet a condition; NULL for an empty table."""
    return df.agg(_share(F.count_if(cond), F.count(F.lit(1))).alias(name))


def pct_of(part: DataFrame, whole: DataFrame, name: str = "pct") -> DataFrame:
    """One row: rows of one table as percent of the rows of another; NULL if that is empty.

    Each table is counted where it lies and the two counts meet in one small
    aggregate, so no join is needed.
    """
    counts = row_count(part).withColumn("side", F.lit("part")).unionByName(
        row_count(whole).withColumn("side", F.lit("whole"))
    )
    return counts.agg(
        _share(
            F.max(F.when(F.col("side") == "part", F.col("n"))),
            F.max(F.when(F.col("side") == "whole", F.col("n"))),
        ).alias(name)
    )


def metrics_long(wide: DataFrame, run_id: str | None = None) -> DataFrame:
    """One row of named numbers turned into rows (run_id, metric_name, metric_value)."""
    names = wide.columns
    typed = wide.select(*[F.col(c).cast("double").alias(c) for c in names])
    out = typed.unpivot([], names, "metric_name", "metric_value")
    return out.select(F.lit(run_id).cast("string").alias("run_id"), "metric_name", "metric_value")


def preview(df: DataFrame, order: list[str], n: int = 20) -> DataFrame:
    """The first n rows in an order."""
    return df.orderBy(*order).limit(n)


def most_recent(df: DataFrame, order: list[str], k: int = 5) -> DataFrame:
    """The last k rows by the order columns, newest first."""
    return df.orderBy(*[F.col(o).desc() for o in order]).limit(k)


def layer_counts(**layers: DataFrame) -> DataFrame:
    """One row with the number of rows of each named layer."""
    out = None
    for name, df in layers.items():
        one = row_count(df).withColumn("layer", F.lit(name))
        out = one if out is None else out.unionByName(one)
    return out.agg(*[F.max(F.when(F.col("layer") == n, F.col("n"))).alias(n) for n in layers])


def offset_progress(bronze: DataFrame) -> DataFrame:
    """Highest offset and number of records per topic and partition."""
    return bronze.groupBy("topic", "partition").agg(
        F.max("offset").alias("max_offset"), F.count(F.lit(1)).alias("n")
    )
