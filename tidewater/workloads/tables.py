"""Tables that are merged by bucket, logs by consumed offsets, checksums, and audits before publication."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.errors import DataQualityError
from tidewater.operators import cdc, checksums, history, offsets
from tidewater.operators.quality import TableChecks
from tidewater.plans import bucketed
from tidewater.plans.cdc import current
from tidewater.plans.publish import publish
from tidewater.plans.replicate import Replication, replicate
from tidewater.session import fresh_path, staged
from tidewater.sources import read_parquet
from tidewater.workloads import shapes
from tidewater.workloads.changes import _MIRROR_SQL, MIRROR, STATE
from tidewater.workloads.registry import query
from tidewater.workloads.shapes import CDC_SQL, IMAGE, table

BUCKETS = 16

# -- merges by bucket --------------------------------------------------------


@query("upsert_bucketed", """
with days as (select max(o_orderdate) as d from orders),
late as (
  select o_custkey, max(o_totalprice) as top from orders, days
  where o_orderdate >= d - interval 30 day and o_custkey is not null group by 1)
select c_custkey, coalesce(top, c_acctbal) as c_acctbal from customer left join late on c_custkey = o_custkey
union all select o_custkey, top from late where o_custkey not in (select c_custkey from customer)""")
def upsert_bucketed(spark: SparkSession, sf: str) -> DataFrame:
    """All customers, then what those who ordered in the last month have spent; only their buckets are rewritten."""
    path = f"{fresh_path(spark, 'bucketed')}/customer"
    customers = table(spark, sf, "customer").select("c_custkey", "c_acctbal")
    bucketed.upsert_bucketed(spark, path, customers, ["c_custkey"], BUCKETS)
    orders = table(spark, sf, "orders").select("o_custkey", "o_totalprice", shapes.ts("o_orderdate").alias("t"))
    newest = orders.agg(F.max("t").alias("t")).first()["t"]
    recent = orders.filter(F.col("t") >= F.lit(newest) - F.expr("interval 30 days"))
    spent = recent.filter(F.col("o_custkey").isNotNull()).groupBy(F.col("o_custkey").alias("c_custkey"))
    bucketed.upsert_bucketed(spark, path, spent.agg(F.max("o_totalprice").alias("c_acctbal")), ["c_custkey"], BUCKETS)
    return bucketed.read_bucketed(spark, path, BUCKETS)


def _events(spark: SparkSession, sf: str) -> DataFrame:
    return cdc.parse_cdc(shapes.change_log(spark, sf), IMAGE)


@query("cdc_bucketed", _MIRROR_SQL)
def cdc_bucketed(spark: SparkSession, sf: str) -> DataFrame:
    """The change log in two batches and the first one again, into a mirror that keeps deleted keys, marked."""
    path = f"{fresh_path(spark, 'bucketed')}/mirror"
    events = staged(_events(spark, sf), "events")
    half = F.lit("2024-01-16").cast("timestamp")
    first, second = events.filter(F.col("timestamp") < half), events.filter(F.col("timestamp") >= half)
    empty = spark.createDataFrame([], STATE)
    for batch in (first, second, first):
        bucketed.apply_changes_bucketed(spark, path, batch, "id", ["name", "cents"], BUCKETS, empty)
    return current(bucketed.read_bucketed(spark, path, BUCKETS))


@query("merge_cdc_bucketed", _MIRROR_SQL)
def merge_cdc_bucketed(spark: SparkSession, sf: str) -> DataFrame:
    """The latest events of each half of the log, into a mirror whose deleted rows go."""
    path = f"{fresh_path(spark, 'bucketed')}/mirror"
    events = staged(cdc.with_entity_key(_events(spark, sf)), "events")
    half = F.lit("2024-01-16").cast("timestamp")
    empty = spark.createDataFrame([], MIRROR)
    values = {"name": "after_name", "cents": "after_cents", "last_updated_ms": "ts_ms"}
    for batch in (events.filter(F.col("timestamp") < half), events.filter(F.col("timestamp") >= half)):
        changes = cdc.latest_changes(batch)
        bucketed.merge_cdc_bucketed(spark, path, changes, "id", values, BUCKETS, empty, check=False)
    return bucketed.read_bucketed(spark, path, BUCKETS)


# -- consumed offsets --------------------------------------------------------


@query("consumed_records", f"with {shapes.LOG_SQL} select topic, part as partition, off as offset from log")
def consumed_records(spark: SparkSession, sf: str) -> DataFrame:
    """The log arrives in batches out of order and overlapping, one of them twice; each record is stored once."""
    root = fresh_path(spark, "consumed")
    log = staged(shapes.log(spark, sf), "log")
    hour = F.hour("timestamp")
    early, third = hour < 18, F.col("offset") % 3 == 0
    for number, batch in ((0, hour >= 12), (1, early), (1, early), (2, third), (3, F.lit(True))):
        offsets.append_consumed(log.filter(batch), f"{root}/bronze", f"{root}/offsets", number)
    return read_parquet(spark, f"{root}/bronze").select("topic", "partition", "offset")


_ISLANDS_SQL = f"""
{shapes.LOG_SQL},
islands as (
  select topic, part, min(off) as first, max(off) as last from (
    select *, off - row_number() over (partition by topic, part order by off) as island
    from (select distinct topic, part, off from log where hour(ts) >= 6)) group by topic, part, island)"""


@query("offset_intervals", f"with {_ISLANDS_SQL} select topic, part as partition, first, last from islands")
def offset_intervals(spark: SparkSession, sf: str) -> DataFrame:
    """The offsets of all but the night's records, as the union of two sets that overlap."""
    log = shapes.log(spark, sf).filter(F.hour("timestamp") >= 6)
    parts = [log.filter(F.hour("timestamp") < 18), log.filter(F.hour("timestamp") >= 12)]
    return offsets.union_intervals(*map(offsets.intervals_of, parts))


@query("offset_gaps", f"""
with {_ISLANDS_SQL}
select * from (
  select topic, part as partition, lag(last) over w + 1 as first, first - 1 as last from islands
  window w as (partition by topic, part order by first)) where first is not null""")
def offset_gaps(spark: SparkSession, sf: str) -> DataFrame:
    """Which offsets are missing in between."""
    log = shapes.log(spark, sf).filter(F.hour("timestamp") >= 6)
    return offsets.gaps(staged(offsets.intervals_of(log), "offsets"))


@query("not_consumed", f"""
with {shapes.LOG_SQL} select topic, part as partition, off as offset from log where hour(ts) < 6""")
def not_consumed(spark: SparkSession, sf: str) -> DataFrame:
    """The whole log against the offsets of all but the night's records."""
    log = shapes.log(spark, sf)
    consumed = offsets.intervals_of(log.filter(F.hour("timestamp") >= 6))
    return offsets.not_consumed(log, consumed).select("topic", "partition", "offset")


# -- checksums ---------------------------------------------------------------


@query("reconcile_tree", f"""
with {CDC_SQL}
select id, case when op = 'd' then 'missing' else 'changed' end as diff from latest
where op = 'd' or name = 'click'""")
def reconcile_tree(spark: SparkSession, sf: str) -> DataFrame:
    """A source with the deleted users and other values for some, against a bucketed mirror and its stored checksums."""
    root = fresh_path(spark, "bucketed")
    events = staged(cdc.with_entity_key(_events(spark, sf)), "events")
    empty = spark.createDataFrame([], MIRROR)
    bucketed.apply_changes_bucketed(spark, f"{root}/mirror", events, "id", ["name", "cents"], BUCKETS, empty)
    mirror = read_parquet(spark, f"{root}/mirror")
    keys, values = ["id"], ["name", "cents"]
    sums = staged(checksums.bucket_checksums(mirror, keys, values, BUCKETS), "checksums")
    source = cdc.latest_changes(events).select(
        F.col("entity_id").alias("id"),
        F.coalesce("after_name", "before_name").alias("name"),
        F.when(F.col("after_name") == "click", -1).otherwise(F.coalesce("after_cents", "before_cents")).alias("cents"),
    )
    return checksums.reconcile_tree(source, mirror, keys, values, BUCKETS, mirror_sums=sums)


# -- audit before publication ------------------------------------------------


@query("publish_audited", "select o_orderkey, o_totalprice, year(o_orderdate) as o_year from orders")
def publish_audited(spark: SparkSession, sf: str) -> DataFrame:
    """All orders are published by year; then a batch that repeats keys is refused, and readers see nothing of it."""
    path = f"{fresh_path(spark, 'published')}/orders"
    orders = table(spark, sf, "orders").select("o_orderkey", "o_totalprice", F.year("o_orderdate").alias("o_year"))
    cfg = TableChecks("orders", "o_orderkey", ["o_totalprice"])
    publish(orders, path, cfg, f"{path}-alerts", ("o_year",))
    twice = orders.unionByName(orders).withColumn("o_totalprice", F.lit(0.0))
    try:
        publish(twice, path, cfg, f"{path}-alerts", ("o_year",))
    except DataQualityError:
        return read_parquet(spark, path).select("o_orderkey", "o_totalprice", F.col("o_year").cast("bigint"))
    raise AssertionError("repeated keys were published")


@query("replicate_refused", """
select 1::bigint as snapshot_id, 1::bigint as runs, count(*) as n, count(distinct c_custkey) as keys from customer""")
def replicate_refused(spark: SparkSession, sf: str) -> DataFrame:
    """A run, then one that its audit refuses: the current snapshot and the ledger are those of the first."""
    root = fresh_path(spark, "replica")
    columns = table(spark, sf, "customer").select("c_custkey", "c_name")
    columns.write.option("header", True).csv(f"{root}/source")
    columns.withColumn("c_custkey", F.lit(None).cast("bigint")).write.option("header", True).csv(f"{root}/nulls")
    for day, source in ((date(2024, 5, 1), "source"), (date(2024, 5, 2), "nulls")):
        cfg = Replication(
            "customer", "c_custkey", f"{root}/{source}", f"{root}/history", f"{root}/ledger", ["c_name"],
            f"{root}/alerts", "c_custkey bigint, c_name string",
        )
        try:
            replicate(spark, cfg, day)
        except DataQualityError:
            continue
    now = history.current_snapshot_id(spark, cfg.root)
    state = history.state_at(spark, cfg.root, now)
    facts = state.agg(F.count(F.lit(1)).alias("n"), F.count_distinct("c_custkey").alias("keys"))
    runs = history.read_ledger(spark, cfg.ledger_path).count()
    numbers = {"snapshot_id": F.lit(now).cast("bigint"), "runs": F.lit(runs).cast("bigint")}
    return facts.withColumns(numbers)
