"""Change-data capture over the events table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.operators import cdc, clean, dedup
from tidewater.plans.cdc import apply_changes, current
from tidewater.session import staged
from tidewater.workloads import shapes
from tidewater.workloads.registry import query
from tidewater.workloads.shapes import CDC_SQL, IMAGE, table

MIRROR = "id bigint, name string, cents bigint, last_updated_ms bigint"
_MIRROR_SQL = f"with {CDC_SQL} select id, name, cents, ts_ms as last_updated_ms from latest where op <> 'd'"


def _events(spark: SparkSession, sf: str) -> DataFrame:
    return cdc.parse_cdc(shapes.change_log(spark, sf), IMAGE)


def _empty(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], MIRROR)


def _mirror(spark: SparkSession, sf: str) -> DataFrame:
    return apply_changes(_empty(spark), _events(spark, sf), "id", ["name", "cents"])


@query("parse_cdc", f"""
with {CDC_SQL}
select op, case when op <> 'c' then id end as before_id, case when op <> 'd' then id end as after_id,
       case when op <> 'd' then name end as after_name, case when op <> 'd' then cents end as after_cents,
       lsn as source_lsn, ts_ms from cdc""")
def parse_cdc(spark: SparkSession, sf: str) -> DataFrame:
    return _events(spark, sf).select(
        "op", "before_id", "after_id", "after_name", "after_cents", "source_lsn", "ts_ms"
    )


@query("parse_cdc_nested", f"""
with {CDC_SQL}
select op, case when op <> 'c' then id end as before_id, case when op <> 'd' then cents end as after_cents,
       ts_ms, 'users' as "table" from cdc""")
def parse_cdc_nested(spark: SparkSession, sf: str) -> DataFrame:
    image = "struct<id:bigint,name:string,cents:bigint>"
    events = cdc.parse_cdc_nested(shapes.change_log(spark, sf), image)
    return events.select(
        "op", F.col("before.id").alias("before_id"), F.col("after.cents").alias("after_cents"), "ts_ms", "table"
    )


@query("drop_tombstones", """
select count(*) as records, count(*) + count(*) filter (where event_type = 'error') as with_tombstones from events""")
def drop_tombstones(spark: SparkSession, sf: str) -> DataFrame:
    log = shapes.change_log(spark, sf)
    kept = cdc.drop_tombstones(log).agg(F.count(F.lit(1)).alias("records"), F.lit(0).alias("all"))
    every = log.agg(F.lit(0).alias("records"), F.count(F.lit(1)).alias("all"))
    return kept.unionByName(every).agg(F.sum("records").alias("records"), F.sum("all").alias("with_tombstones"))


@query("payload_schema", f"""
with {CDC_SQL}
select op, count(*) as n, sum(case when op <> 'd' then cents end) as cents, max(ts_ms) as ts_ms from cdc group by 1""")
def payload_schema(spark: SparkSession, sf: str) -> DataFrame:
    """The log parsed with the type inferred from it; its first records have no after image or no before image."""
    log = cdc.drop_tombstones(shapes.change_log(spark, sf))
    kind = cdc.infer_payload_schema(log).replace("OBJECT<", "STRUCT<")
    parsed = log.select(F.from_json("value", kind).alias("v")).select("v.payload.*")
    return parsed.groupBy("op").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.col("after.cents").cast("bigint")).alias("cents"),
        F.max(F.col("ts_ms").cast("bigint")).alias("ts_ms"),
    )


@query("entity_key", f"with {CDC_SQL} select lsn as source_lsn, id as entity_id from cdc")
def entity_key(spark: SparkSession, sf: str) -> DataFrame:
    return cdc.with_entity_key(_events(spark, sf)).select("source_lsn", "entity_id")


@query("with_ops", f"with {CDC_SQL} select lsn as source_lsn, op from cdc where op in ('c', 'u')")
def with_ops(spark: SparkSession, sf: str) -> DataFrame:
    return clean.with_ops(_events(spark, sf), "c", "u").select("source_lsn", "op")


@query("op_counts", f"with {CDC_SQL} select op, count(*) as n from cdc group by op")
def op_counts(spark: SparkSession, sf: str) -> DataFrame:
    return cdc.op_counts(_events(spark, sf))


@query("latest_per_key", f"with {CDC_SQL} select id, op, name, cents, ts_ms, lsn from latest")
def latest_per_key(spark: SparkSession, sf: str) -> DataFrame:
    events = table(spark, sf, "events").select(
        F.col("user_id").alias("id"),
        F.when(F.col("event_type") == "signup", "c").when(F.col("event_type") == "error", "d").otherwise("u").alias("op"),
        F.col("event_type").alias("name"),
        shapes.cents("value").alias("cents"),
        F.unix_millis(shapes.ts("ts")).alias("ts_ms"),
        F.col("event_id").alias("lsn"),
    )
    return dedup.latest_per_key(events, ["id"], ["ts_ms", "lsn"])


@query("latest_changes", f"with {CDC_SQL} select id as entity_id, op, ts_ms, lsn as source_lsn from latest")
def latest_changes(spark: SparkSession, sf: str) -> DataFrame:
    latest = cdc.latest_changes(cdc.with_entity_key(_events(spark, sf)))
    return latest.select("entity_id", "op", "ts_ms", "source_lsn")


@query("new_events", """
select event_id * 2 as "offset" from events where event_type = 'purchase'
union all select event_id * 2 from events where event_type = 'signup'""")
def new_events(spark: SparkSession, sf: str) -> DataFrame:
    """A log that is read again from its start; bronze holds all but two kinds already."""
    events = table(spark, sf, "events")
    have = shapes.as_change_records(events.filter(~F.col("event_type").isin("purchase", "signup")))
    return cdc.new_events(have, shapes.as_change_records(events)).select("offset")


@query("cdc_mirror", _MIRROR_SQL)
def cdc_mirror(spark: SparkSession, sf: str) -> DataFrame:
    return _mirror(spark, sf)


@query("merge_cdc", _MIRROR_SQL)
def merge_cdc(spark: SparkSession, sf: str) -> DataFrame:
    """The log in two batches: the second one updates, deletes and adds rows of the first one's mirror."""
    events = _events(spark, sf)
    half = F.lit("2024-01-16").cast("timestamp")
    values = ["name", "cents"]
    first = apply_changes(_empty(spark), events.filter(F.col("timestamp") < half), "id", values)
    return apply_changes(first, events.filter(F.col("timestamp") >= half), "id", values)


@query("cdc_reapply", _MIRROR_SQL)
def cdc_reapply(spark: SparkSession, sf: str) -> DataFrame:
    """Applying a log to the mirror it made changes nothing."""
    return apply_changes(_mirror(spark, sf), _events(spark, sf), "id", ["name", "cents"])


@query("reconcile", f"""
with {CDC_SQL},
sides as (
  select id, true as is_source, true as is_mirror from latest where op <> 'd'
  union all select id, true, false from latest where op = 'd')
select 'same' as side, count(*) filter (is_mirror) as source_n, count(*) filter (is_mirror) as mirror_n, true as matches from sides
union all
select 'with_deleted', count(*), count(*) filter (is_mirror), count(*) = count(*) filter (is_mirror) from sides""")
def reconcile(spark: SparkSession, sf: str) -> DataFrame:
    """The mirror against its source, and against one that still has the deleted users."""
    mirror = staged(_mirror(spark, sf), "mirror")
    deleted = cdc.latest_changes(cdc.with_entity_key(_events(spark, sf))).filter("op = 'd'")
    more = _source(spark, sf).select("id").unionByName(deleted.select(F.col("entity_id").alias("id")))
    return (
        cdc.reconcile(_source(spark, sf), mirror).withColumn("side", F.lit("same"))
        .unionByName(cdc.reconcile(more, mirror).withColumn("side", F.lit("with_deleted")))
    )


STATE = MIRROR + ", last_lsn bigint, deleted boolean"


@query("cdc_replay", _MIRROR_SQL)
def cdc_replay(spark: SparkSession, sf: str) -> DataFrame:
    """The log in two batches, then the first one again, as after a replay: older events change nothing."""
    events = staged(_events(spark, sf), "events")
    half = F.lit("2024-01-16").cast("timestamp")
    first, second = events.filter(F.col("timestamp") < half), events.filter(F.col("timestamp") >= half)
    state = spark.createDataFrame([], STATE)
    for batch in (first, second, first):
        state = staged(apply_changes(state, batch, "id", ["name", "cents"]), "state")
    return current(state)


@query("cdc_two_tables", _MIRROR_SQL)
def cdc_two_tables(spark: SparkSession, sf: str) -> DataFrame:
    """A log of two tables with equal ids; each mirror takes its own."""
    events = table(spark, sf, "events")
    other = events.withColumns({"value": -F.col("value"), "ts": F.col("ts") + F.expr("interval 1 day")})
    both = shapes.as_change_records(events).unionByName(shapes.as_change_records(other, "drivers"))
    return apply_changes(_empty(spark), cdc.parse_cdc(both, IMAGE), "id", ["name", "cents"], "users")


def _source(spark: SparkSession, sf: str) -> DataFrame:
    """The current users straight from the events, by aggregation instead of a merge."""
    last = table(spark, sf, "events").groupBy(F.col("user_id").alias("id")).agg(
        F.max_by(F.struct(F.col("event_type").alias("name"), shapes.cents("value").alias("cents")),
                 F.struct("ts", "event_id")).alias("r")
    )
    return last.select("id", "r.*").filter(F.col("name") != "error")


@query("reconcile_rows", f"""
with {CDC_SQL}
select id, case when op = 'd' then 'missing' else 'changed' end as diff from latest
where op = 'd' or name = 'click'""")
def reconcile_rows(spark: SparkSession, sf: str) -> DataFrame:
    """A source that still has the deleted users and other values for some."""
    last = dedup.latest_per_key(
        cdc.with_entity_key(_events(spark, sf)), ["entity_id"], ["ts_ms", "source_lsn"]
    )
    source = last.select(
        F.col("entity_id").alias("id"),
        F.coalesce("after_name", "before_name").alias("name"),
        F.when(F.col("after_name") == "click", -1).otherwise(F.coalesce("after_cents", "before_cents")).alias("cents"),
    )
    return cdc.reconcile_rows(source, _mirror(spark, sf), ["id"], ["name", "cents"])
