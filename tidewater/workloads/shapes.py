"""The given tables in the shapes the operators work on, and the same shapes as SQL.

Money is held as whole cents, so that a sum is exact and does not depend on the
order in which tasks deliver their parts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def ts(c: str) -> Column:
    """A zoneless time of the given tables as a timestamp (the session zone is UTC)."""
    return F.col(c).cast("timestamp")


def ntz(df: DataFrame) -> DataFrame:
    """Timestamps back to zoneless ones, as in the given tables."""
    times = [n for n, t in df.dtypes if t == "timestamp"]
    return df.withColumns({n: F.col(n).cast("timestamp_ntz") for n in times})


def cents(c: str) -> Column:
    return F.round(F.col(c) * 100).cast("bigint")


# -- trips: line items, picked up at the order's date and dropped off at the ship date


def lines(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        "l_suppkey",
        F.col("l_quantity").alias("trip_distance"),
        cents("l_extendedprice").alias("fare_amount"),
        F.col("l_linenumber").alias("passenger_count"),
        ts("l_shipdate").alias("dropoff_ts"),
    )


LINE_ORDER = ["l_partkey", "l_suppkey", "fare_amount", "dropoff_ts"]
LINE_KEY = ["l_orderkey", "l_linenumber"]


def pickups(spark: SparkSession, sf: str, zones: bool = True) -> DataFrame:
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey", ts("o_orderdate").alias("pickup_ts"))
    if not zones:
        return orders.drop("o_custkey")
    customer = table(spark, sf, "customer").select("c_custkey", F.col("c_nationkey").alias("PULocationID"))
    return orders.join(customer, F.col("o_custkey") == F.col("c_custkey")).drop("o_custkey", "c_custkey")


def timed_trips(spark: SparkSession, sf: str, items: DataFrame | None = None) -> DataFrame:
    """Trips with times only; no zone is looked up."""
    items = lines(spark, sf) if items is None else items
    return items.join(pickups(spark, sf, False), F.col("l_orderkey") == F.col("o_orderkey")).drop("o_orderkey")


def flawed_trips(spark: SparkSession, sf: str) -> DataFrame:
    """Timed trips of which some have no pickup time, no dropoff time or negative counts."""
    df = timed_trips(spark, sf)
    return df.withColumns(
        {
            "pickup_ts": F.when(F.col("l_linenumber") != 7, F.col("pickup_ts")),
            "dropoff_ts": F.when(F.col("l_partkey") % 11 != 0, F.col("dropoff_ts")),
            "trip_distance": F.when(F.col("l_suppkey") % 5 == 0, -F.col("trip_distance")).otherwise(F.col("trip_distance")),
            "passenger_count": F.when(F.col("l_partkey") % 13 != 0, F.col("passenger_count")),
        }
    )


def pickup_trips(spark: SparkSession, sf: str, items: DataFrame | None = None) -> DataFrame:
    """Trips with times and the pickup zone. The smaller pair of tables is joined first."""
    items = lines(spark, sf) if items is None else items
    return items.join(pickups(spark, sf), F.col("l_orderkey") == F.col("o_orderkey")).drop("o_orderkey")


def trips(spark: SparkSession, sf: str, items: DataFrame | None = None) -> DataFrame:
    """Trips with times and both zones."""
    supplier = table(spark, sf, "supplier").select("s_suppkey", F.col("s_nationkey").alias("DOLocationID"))
    return pickup_trips(spark, sf, items).join(supplier, F.col("l_suppkey") == F.col("s_suppkey")).drop("s_suppkey")


def zones(spark: SparkSession, sf: str) -> DataFrame:
    region = table(spark, sf, "region")
    return table(spark, sf, "nation").join(region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.col("n_nationkey").alias("LocationID"), F.col("n_name").alias("Zone"), F.col("r_name").alias("Borough")
    )


TRIPS_SQL = """
trips as (
  select l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity as trip_distance,
         cast(round(l_extendedprice * 100) as bigint) as fare_amount, l_linenumber as passenger_count,
         o_orderdate as pickup_ts, l_shipdate as dropoff_ts, c_nationkey as pu, s_nationkey as dl
  from lineitem
  join orders on l_orderkey = o_orderkey
  join customer on o_custkey = c_custkey
  join supplier on l_suppkey = s_suppkey
)"""

TIMED_SQL = """
trips as (
  select l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity as trip_distance,
         cast(round(l_extendedprice * 100) as bigint) as fare_amount, l_linenumber as passenger_count,
         o_orderdate as pickup_ts, l_shipdate as dropoff_ts
  from lineitem join orders on l_orderkey = o_orderkey
)"""

FLAWED_SQL = TIMED_SQL.replace("trips as", "timed as") + """,
trips as (
  select * exclude (pickup_ts, dropoff_ts, trip_distance, passenger_count),
         case when l_linenumber <> 7 then pickup_ts end as pickup_ts,
         case when l_partkey % 11 <> 0 then dropoff_ts end as dropoff_ts,
         case when l_suppkey % 5 = 0 then -trip_distance else trip_distance end as trip_distance,
         case when l_partkey % 13 <> 0 then passenger_count end as passenger_count
  from timed
)"""

ZONES_SQL = """
zones as (
  select n_nationkey as id, n_name as zone, r_name as borough
  from nation join region on n_regionkey = r_regionkey
)"""


# -- event log: one record per event; the offset rises within a topic and partition


def events_schema(spark: SparkSession, sf: str):
    return table(spark, sf, "events").schema


def as_records(events: DataFrame) -> DataFrame:
    """Events as log records. A projection only, so it serves streams too."""
    body = F.struct(
        "event_id",
        "user_id",
        "event_type",
        (F.col("user_id") % 25).cast("int").alias("zone"),
        cents("value").alias("value"),
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("ts"),
    )
    return events.select(
        F.col("user_id").cast("string").cast("binary").alias("key"),
        F.to_json(body).cast("binary").alias("value"),
        F.concat(F.lit("events-"), F.col("event_type")).alias("topic"),
        (F.col("user_id") % 3).cast("int").alias("partition"),
        F.col("event_id").alias("offset"),
        ts("ts").alias("timestamp"),
    )


EVENT_PAYLOAD = "event_id bigint, user_id bigint, event_type string, zone int, value bigint, ts string"


def log(spark: SparkSession, sf: str) -> DataFrame:
    return as_records(table(spark, sf, "events"))


LOG_SQL = """
log as (
  select 'events-' || event_type as topic, cast(user_id % 3 as int) as part, event_id as off, ts,
         event_id, user_id, event_type, cast(round(value * 100) as bigint) as cents
  from events
)"""


# -- change log: an event changes the row of its user; errors delete it


def as_change_records(events: DataFrame, name: str = "users") -> DataFrame:
    """Events as change records, each delete followed by a tombstone."""
    kind = F.when(F.col("event_type") == "signup", "c").when(F.col("event_type") == "error", "d").otherwise("u")
    image = F.struct(F.col("user_id").alias("id"), F.col("event_type").alias("name"), cents("value").alias("cents"))
    payload = F.struct(
        kind.alias("op"),
        F.when(kind != "c", image).alias("before"),
        F.when(kind != "d", image).alias("after"),
        F.struct(F.col("event_id").alias("lsn"), F.lit(name).alias("table")).alias("source"),
        F.unix_millis(ts("ts")).alias("ts_ms"),
    )
    record = F.to_json(F.struct(payload.alias("payload")))
    values = F.when(kind == "d", F.array(record, F.lit(None).cast("string"))).otherwise(F.array(record))
    return events.select(
        (F.col("user_id") % 3).cast("int").alias("partition"),
        ts("ts").alias("timestamp"),
        "event_id",
        F.posexplode(values).alias("n", "value"),
    ).select(
        F.lit("db.public.users").alias("topic"),
        "partition",
        (F.col("event_id") * 2 + F.col("n")).alias("offset"),
        "timestamp",
        "value",
    )


IMAGE = {"id": "bigint", "name": "string", "cents": "bigint"}


def change_log(spark: SparkSession, sf: str) -> DataFrame:
    return as_change_records(table(spark, sf, "events"))


CDC_SQL = """
cdc as (
  select user_id as id, event_type as name, cast(round(value * 100) as bigint) as cents,
         case event_type when 'signup' then 'c' when 'error' then 'd' else 'u' end as op,
         epoch_us(ts) // 1000 as ts_ms, event_id as lsn
  from events
),
latest as (
  select * from (
    select *, row_number() over (partition by id order by ts_ms desc, lsn desc) as rn from cdc
  ) where rn = 1
)"""


# -- ledger: orders as merge runs


def ledger(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").select(
        F.col("o_orderpriority").alias("table_name"),
        F.to_date("o_orderdate").alias("execution_date"),
        F.col("o_orderkey").alias("snapshot_id"),
        F.timestamp_seconds("o_orderkey").alias("recorded_at"),
    )


LEDGER_SQL = """
ledger as (
  select o_orderpriority as table_name, cast(o_orderdate as date) as execution_date, o_orderkey as snapshot_id
  from orders
)"""
