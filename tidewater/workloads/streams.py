"""Streaming queries over the events table, run until all its data is taken."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater import streaming
from tidewater.operators.gold import count_by
from tidewater.session import fresh_path, staged
from tidewater.sinks import create_or_append
from tidewater.sources import read_parquet, read_table_stream
from tidewater.workloads import shapes
from tidewater.workloads.registry import query
from tidewater.workloads.shapes import LOG_SQL, ntz, table

# Bytes of a row group of bronze: a file is read by as many tasks as it has row groups.
ROW_GROUP = 16 << 20


def _events(spark: SparkSession, sf: str) -> DataFrame:
    # A glob, because a stream can be given a folder or a pattern but not a file.
    schema = shapes.events_schema(spark, sf)
    return read_table_stream(spark, path=f"{sf}/events.parquet*", schema=schema)


def _bronze(spark: SparkSession, sf: str, root: str, run: str = "a") -> DataFrame:
    records = streaming.bronze_stream(shapes.as_records(_events(spark, sf)))
    streaming.run_once(records, f"{root}/bronze", f"{root}/ckpt/bronze-{run}")
    return read_parquet(spark, f"{root}/bronze")


_BRONZE_SQL = f"with {LOG_SQL} select topic, part as partition, off as offset, ts as kafka_time from log"


@query("bronze_stream", _BRONZE_SQL)
def bronze_stream(spark: SparkSession, sf: str) -> DataFrame:
    return ntz(_bronze(spark, sf, fresh_path(spark, "stream")).drop("value"))


@query("stream_restart", _BRONZE_SQL)
def stream_restart(spark: SparkSession, sf: str) -> DataFrame:
    """Started again on its checkpoint, a stream without new data adds nothing."""
    root = fresh_path(spark, "stream")
    _bronze(spark, sf, root)
    return ntz(_bronze(spark, sf, root).drop("value"))


@query("silver_stream", f"""
with {LOG_SQL}
select event_id, user_id, event_type, cents as value, ts as pickup_ts, n_name as pickup_zone, r_name as pickup_borough
from log left join nation on user_id % 25 = n_nationkey and n_nationkey < 20
left join region on n_regionkey = r_regionkey""")
def silver_stream(spark: SparkSession, sf: str) -> DataFrame:
    """Bronze holds every record twice and comes file by file, not in order of time; silver holds each record once.

    Some zones are missing in the lookup.
    """
    root = fresh_path(spark, "stream")
    records = shapes.as_records(table(spark, sf, "events"))
    for run in ("a", "b"):
        by_hash = records.repartition(4, F.hash("offset", F.lit(run)))
        by_hash.select("value", "topic", "partition", "offset", F.col("timestamp").alias("kafka_time")).write.mode(
            "append"
        ).option("parquet.block.size", ROW_GROUP).parquet(f"{root}/bronze")
    schema = read_parquet(spark, f"{root}/bronze").schema
    bronze = read_table_stream(spark, path=f"{root}/bronze", schema=schema, files_per_batch=3)
    zones = shapes.zones(spark, sf).filter(F.col("LocationID") < 20)
    rows = streaming.silver_rows(
        bronze, zones, shapes.EVENT_PAYLOAD, pickup="ts", dropoff="ts", pickup_zone="zone", dropoff_zone=None
    )
    keys = ["event_id", "user_id", "pickup_ts"]
    streaming.append_new(rows, f"{root}/silver", f"{root}/ckpt/silver", keys, "pickup_ts").awaitTermination()
    columns = ["event_id", "user_id", "event_type", "value", "pickup_ts", "pickup_zone", "pickup_borough"]
    return ntz(read_parquet(spark, f"{root}/silver").select(*columns))


@query("dedup_stream", "select distinct user_id, event_type from events")
def dedup_stream(spark: SparkSession, sf: str) -> DataFrame:
    """Few keys with many copies each, spread by a salt first."""
    root = fresh_path(spark, "stream")
    events = _events(spark, sf)
    first = streaming.dedup_stream(events, ["user_id", "event_type"], salt=F.col("event_id"))
    streaming.run_once(first.select("user_id", "event_type"), f"{root}/out", f"{root}/ckpt")
    return read_parquet(spark, f"{root}/out")


@query("dedup_stream_watermark", "select event_id from events")
def dedup_stream_watermark(spark: SparkSession, sf: str) -> DataFrame:
    """Every event arrives three times; the state is dropped behind the watermark."""
    root = fresh_path(spark, "stream")
    events = _events(spark, sf).withColumn("ts", shapes.ts("ts")).withColumn(
        "copy", F.explode(F.array(F.lit(1), F.lit(2), F.lit(3)))
    )
    first = streaming.dedup_stream(events, ["event_id"], "ts", "10 minutes")
    streaming.run_once(first.select("event_id"), f"{root}/out", f"{root}/ckpt")
    return read_parquet(spark, f"{root}/out")


@query("gold_stream", f"""
with {LOG_SQL}
select topic as pickup_zone, date_trunc('hour', ts) as pickup_hour, count(*) as trip_count,
       sum(cents)::double / count(cents) as avg_fare
from log group by 1, 2
having date_trunc('hour', ts) + interval 1 hour
       <= date_trunc('milliseconds', (select max(ts) from events)) - interval 2 hour""")
def gold_stream(spark: SparkSession, sf: str) -> DataFrame:
    """Windows appear once the watermark has passed them; the last ones stay open."""
    root = fresh_path(spark, "stream")
    silver = _events(spark, sf).select(
        F.concat(F.lit("events-"), F.col("event_type")).alias("pickup_zone"),
        shapes.ts("ts").alias("pickup_ts"),
        shapes.cents("value").alias("fare_amount"),
    )
    streaming.run_once(streaming.gold_stream(silver, "2 hours"), f"{root}/gold", f"{root}/ckpt")
    return ntz(read_parquet(spark, f"{root}/gold"))


@query("stream_to_memory", f"with {LOG_SQL} select topic, count(*) as cnt from log group by 1")
def stream_to_memory(spark: SparkSession, sf: str) -> DataFrame:
    """A small aggregate of the whole stream, kept complete in memory and asked by SQL."""
    root = fresh_path(spark, "stream")
    name = "tw_" + root.rsplit("-", 1)[1]
    counts = count_by(shapes.as_records(_events(spark, sf)), "topic")
    streaming.stream_to_memory(counts, name, f"{root}/ckpt", "complete").awaitTermination()
    return spark.sql(f"select topic, cnt from {name}")


@query("table_stream", "select event_id, event_type from events")
def table_stream(spark: SparkSession, sf: str) -> DataFrame:
    """A catalog table read as a stream."""
    root = fresh_path(spark, "stream")
    name = "tw_" + root.rsplit("-", 1)[1]
    create_or_append(table(spark, sf, "events").select("event_id", "event_type"), name, f"{root}/table")
    streaming.run_once(read_table_stream(spark, name), f"{root}/out", f"{root}/ckpt")
    return read_parquet(spark, f"{root}/out")


@query("corrected_gold", f"""
with {LOG_SQL}
select topic as pickup_zone, date_trunc('hour', ts) as pickup_hour, count(*) as trip_count,
       sum(cents)::double / count(cents) as avg_fare
from log group by 1, 2""")
def corrected_gold(spark: SparkSession, sf: str) -> DataFrame:
    """Every record comes twice and in no order of time, over many micro-batches; gold is that of all rows in the end."""
    root = fresh_path(spark, "stream")
    events = table(spark, sf, "events").select(
        "event_id",
        F.concat(F.lit("events-"), F.col("event_type")).alias("pickup_zone"),
        shapes.ts("ts").alias("pickup_ts"),
        shapes.cents("value").alias("fare_amount"),
    )
    for run in ("a", "b"):
        events.repartition(4, F.hash("event_id", F.lit(run))).write.mode("append").parquet(f"{root}/in")
    rows = read_table_stream(spark, path=f"{root}/in", schema=events.schema, files_per_batch=3)
    streaming.corrected_gold(
        rows, f"{root}/silver", f"{root}/gold", f"{root}/ckpt", ["event_id", "pickup_ts"]
    ).awaitTermination()
    return ntz(read_parquet(spark, f"{root}/gold").drop("gold_day"))


@query("stream_progress", """
select count(*) as input_rows, 0::bigint as late_rows, 1::bigint as queries, 2::bigint as runs from events""")
def stream_progress(spark: SparkSession, sf: str) -> DataFrame:
    """What the engine says of two runs on one checkpoint, of which the second one finds nothing new."""
    root = fresh_path(spark, "stream")
    runs = []
    with streaming.recorded(spark, f"{root}/progress"):
        for _ in range(2):
            records = streaming.bronze_stream(shapes.as_records(_events(spark, sf)))
            started = streaming.stream_append(records, f"{root}/bronze", f"{root}/ckpt")
            started.awaitTermination()
            runs.append(str(started.runId))
    done = streaming.read_progress(spark, f"{root}/progress")
    return done.agg(
        F.coalesce(F.sum("input_rows"), F.lit(0)).alias("input_rows"),
        F.coalesce(F.sum("late_rows"), F.lit(0)).alias("late_rows"),
        F.count_distinct("query_id").alias("queries"),
    ).withColumn("runs", F.lit(len(set(runs))).cast("bigint"))


@query("stream_state", """
select run, count(*) as state_rows from (select distinct user_id, event_type from events), (values (1), (2)) v(run)
group by 1""")
def stream_state(spark: SparkSession, sf: str) -> DataFrame:
    """The state a stream leaves behind after its first run and after a restart without new data."""
    root = fresh_path(spark, "stream")
    found = []
    for run in (1, 2):
        first = streaming.dedup_stream(_events(spark, sf), ["user_id", "event_type"])
        streaming.run_once(first.select("user_id", "event_type"), f"{root}/out", f"{root}/ckpt")
        state = streaming.state_rows(spark, f"{root}/ckpt")
        found.append(staged(state.agg(F.count(F.lit(1)).alias("state_rows")).withColumn("run", F.lit(run)), "state"))
    return found[0].unionByName(found[1])


@query("first_within", """
with copies as (
  select event_id, ts, ts + to_hours(event_id % 5) as arrived, true as first from events
  union all select event_id, ts, ts + to_hours(event_id % 5) + interval 3 day, false from events)
select event_id, arrived, arrived > ts + interval 2 hour as late from copies""")
def first_within(spark: SparkSession, sf: str) -> DataFrame:
    """Each event arrives up to four hours late, ten minutes later again, and three days later once more.

    The second copy is dropped, the third one comes after its key was forgotten; late rows are kept.
    """
    root = fresh_path(spark, "stream")
    after = F.make_dt_interval(hours=(F.col("event_id") % 5).cast("int"))
    copies = F.array(*[F.expr(f"interval {i}") for i in ("0 seconds", "10 minutes", "3 days")])
    events = table(spark, sf, "events").select("event_id", shapes.ts("ts").alias("ts")).select(
        "event_id", "ts", F.explode(F.transform(copies, lambda i: F.col("ts") + after + i)).alias("arrived")
    )
    events = staged(events, "copies")
    low, high = (r.timestamp() for r in events.agg(F.min("arrived"), F.max("arrived")).first())
    parts = 4
    # Milliseconds are cut off, so the first row's are before its time.
    part = F.greatest(F.lit(0), F.floor((F.unix_millis("arrived") / 1000 - low) / (high - low + 1) * parts))
    for n in range(parts):
        events.filter(part == n).repartition(2, "event_id").write.mode("append").parquet(f"{root}/in")
    rows = read_table_stream(spark, path=f"{root}/in", schema=events.schema, files_per_batch=2)
    first = streaming.first_within(rows, ["event_id"], "ts", "arrived", "2 hours", 86_400)
    with streaming.rocksdb_state(spark):
        streaming.run_once(first, f"{root}/out", f"{root}/ckpt")
    return ntz(read_parquet(spark, f"{root}/out").select("event_id", "arrived", "late"))
