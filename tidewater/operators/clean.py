"""Typing, cleaning rules, derived columns and reject reports for trips."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.functions import parse_ts, seconds_between, stable_id
from tidewater.sources.files import with_source_file


@dataclass(frozen=True)
class Trip:
    """Column names of a trip table, for data that names them differently."""

    pickup: str = "pickup_ts"
    dropoff: str = "dropoff_ts"
    distance: str = "trip_distance"
    fare: str = "fare_amount"
    passengers: str = "passenger_count"
    pickup_zone: str = "PULocationID"
    dropoff_zone: str = "DOLocationID"


TRIP = Trip()


def typed_trips(df: DataFrame, trip: Trip = TRIP, pickup: str | None = None, dropoff: str | None = None) -> DataFrame:
    """Trip columns in their types; a value that cannot be converted becomes NULL.

    ``pickup`` and ``dropoff`` name the raw time columns where they differ.
    """
    return df.withColumns(
        {
            trip.pickup: parse_ts(pickup or trip.pickup),
            trip.dropoff: parse_ts(dropoff or trip.dropoff),
            trip.passengers: F.col(trip.passengers).try_cast("int"),
            trip.distance: F.col(trip.distance).try_cast("double"),
            trip.fare: F.col(trip.fare).try_cast("double"),
        }
    )


def clean_ts(df: DataFrame, trip: Trip = TRIP) -> DataFrame:
    """Trips with both times."""
    return df.filter(F.col(trip.pickup).isNotNull() & F.col(trip.dropoff).isNotNull())


def clean_basic(df: DataFrame, trip: Trip = TRIP) -> DataFrame:
    """Trips with both times, no negative distance and no negative passenger count.

    A NULL distance or count fails its comparison, so those trips go too.
    """
    return clean_ts(df, trip).filter((F.col(trip.distance) >= 0) & (F.col(trip.passengers) >= 0))


def clean_strict(df: DataFrame, trip: Trip = TRIP) -> DataFrame:
    """Trips that end after they start, cover a distance, cost money and carry 1 to 6 people."""
    return clean_ts(df, trip).filter(
        (F.col(trip.pickup) < F.col(trip.dropoff))
        & (F.col(trip.distance) > 0)
        & (F.col(trip.fare) > 0)
        & F.col(trip.passengers).between(1, 6)
    )


def reject_counts(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """Rows (rule, rejected): how many rows each rule rejects, all in one pass."""
    counts = df.agg(*[F.count_if(bad).alias(name) for name, bad in rules.items()])
    return counts.unpivot([], list(rules), "rule", "rejected")


def reject_samples(df: DataFrame, rules: dict[str, Column], n: int = 5) -> DataFrame:
    """Up to n rejected rows per rule, to look at."""
    parts = [df.filter(bad).limit(n).withColumn("rule", F.lit(name)) for name, bad in rules.items()]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def with_duration(df: DataFrame, trip: Trip = TRIP, name: str = "trip_duration_minutes") -> DataFrame:
    """Trip duration in minutes, from whole seconds."""
    return df.withColumn(name, seconds_between(trip.pickup, trip.dropoff) / 60)


def with_pickup_date(df: DataFrame, trip: Trip = TRIP) -> DataFrame:
    """Day of the pickup."""
    return df.withColumn("pickup_date", F.to_date(trip.pickup))


def with_pickup_hour(df: DataFrame, trip: Trip = TRIP) -> DataFrame:
    """Hour of the pickup."""
    return df.withColumn("pickup_hour", F.date_trunc("hour", trip.pickup))


def with_lineage(df: DataFrame) -> DataFrame:
    """Source file and ingestion time; to be called right on the scan."""
    return with_source_file(df).withColumn("ingested_at", F.current_timestamp())


def with_row_id(df: DataFrame, *keys: str, name: str = "trip_id") -> DataFrame:
    """A row id from the key columns, or from all columns."""
    return df.withColumn(name, stable_id(*(keys or df.columns)))


def max_time(df: DataFrame, ts: str) -> Column:
    """The newest time in a table, as a scalar to use in an expression over any table."""
    return df.agg(F.max(ts)).scalar()


def last_n_months(df: DataFrame, ts: str, n: int | None) -> DataFrame:
    """Rows from n months before the newest one on, cut at midnight.

    The newest time comes from a scalar subquery that reads this one column.
    """
    if not n or n <= 0:
        return df
    cutoff = df.agg(F.add_months(F.max(ts), -n)).scalar()
    return df.filter(F.col(ts) >= cutoff)


def between_dates(df: DataFrame, ts: str, lo: str, hi: str) -> DataFrame:
    """Rows with lo <= ts < hi; prunes partitions when ts is a partition column."""
    return df.filter((F.col(ts) >= lo) & (F.col(ts) < hi))


def with_ops(df: DataFrame, *ops: str, col: str = "op") -> DataFrame:
    """Change events of the given kinds."""
    return df.filter(F.col(col).isin(*ops))


def for_run(df: DataFrame, run_id: str, col: str = "run_id") -> DataFrame:
    """Rows that belong to one run."""
    return df.filter(F.col(col) == run_id)
