"""Sources, sinks, cleaning, joins, aggregates and merges over the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater import sinks, sources
from tidewater.functions import fingerprint, json_double, json_set, json_text, l2_normalize, parse_ts, text_or_empty
from tidewater.operators import clean, dedup, enrich, gold, merge, sketches
from tidewater.plans import trips as trip_plans
from tidewater.session import fresh_path, staged
from tidewater.streaming import parse_json_payload
from tidewater.workloads import shapes
from tidewater.workloads.registry import query
from tidewater.workloads.shapes import FLAWED_SQL, LINE_KEY, LINE_ORDER, LOG_SQL, TIMED_SQL, TRIPS_SQL, ZONES_SQL, ntz, table

ROW = "l_orderkey, l_linenumber, l_partkey, l_suppkey"
ROW_COLS = ROW.split(", ")
FIRST_LINE_SQL = """
select *, row_number() over (
  partition by l_orderkey, l_linenumber order by l_partkey, l_suppkey, l_extendedprice, l_shipdate) as rn
from lineitem"""

# -- cleaning ----------------------------------------------------------------


@query("clean_basic", f"""
with {FLAWED_SQL}
select count(*) as kept, sum(fare_amount) as fares from trips
where trip_distance >= 0 and passenger_count >= 0 and pickup_ts is not null and dropoff_ts is not null""")
def clean_basic(spark: SparkSession, sf: str) -> DataFrame:
    kept = clean.clean_basic(shapes.flawed_trips(spark, sf))
    return kept.agg(F.count(F.lit(1)).alias("kept"), F.sum("fare_amount").alias("fares"))


@query("clean_ts", f"""
with {FLAWED_SQL} select {ROW} from trips where pickup_ts is not null and dropoff_ts is not null""")
def clean_ts(spark: SparkSession, sf: str) -> DataFrame:
    return clean.clean_ts(shapes.flawed_trips(spark, sf)).select(*ROW_COLS)


@query("clean_strict", f"""
with {TIMED_SQL}
select {ROW}, trip_distance, fare_amount from trips
where pickup_ts < dropoff_ts and trip_distance > 0 and fare_amount > 0 and passenger_count between 1 and 6""")
def clean_strict(spark: SparkSession, sf: str) -> DataFrame:
    return clean.clean_strict(shapes.timed_trips(spark, sf)).select(*ROW_COLS, "trip_distance", "fare_amount")


@query("reject_counts", f"""
with {TIMED_SQL}
select 'too_short' as rule, count(*) filter (where trip_distance < 5) as rejected from trips
union all select 'too_many', count(*) filter (where passenger_count > 6) from trips
union all select 'backwards', count(*) filter (where pickup_ts >= dropoff_ts) from trips""")
def reject_counts(spark: SparkSession, sf: str) -> DataFrame:
    rules = {
        "too_short": F.col("trip_distance") < 5,
        "too_many": F.col("passenger_count") > 6,
        "backwards": F.col("pickup_ts") >= F.col("dropoff_ts"),
    }
    return clean.reject_counts(shapes.timed_trips(spark, sf), rules)


@query("typed_trips", f"""
with {TIMED_SQL}
select {ROW}, case when passenger_count > 6 then null else pickup_ts end as pickup_ts, dropoff_ts,
       case when trip_distance > 40 then null else trip_distance end as trip_distance,
       cast(passenger_count as int) as passenger_count, cast(fare_amount as double) as fare_amount
from trips""")
def typed_trips(spark: SparkSession, sf: str) -> DataFrame:
    """Every column comes as text; some texts do not fit their type."""
    raw = shapes.timed_trips(spark, sf)
    text = raw.select(
        *ROW_COLS,
        F.when(F.col("passenger_count") > 6, "not a time").otherwise(F.col("pickup_ts").cast("string")).alias("pickup_ts"),
        F.col("dropoff_ts").cast("string").alias("dropoff_ts"),
        F.when(F.col("trip_distance") > 40, "far").otherwise(F.col("trip_distance").cast("string")).alias("trip_distance"),
        F.col("passenger_count").cast("string").alias("passenger_count"),
        F.col("fare_amount").cast("string").alias("fare_amount"),
    )
    return ntz(clean.typed_trips(text))


@query("duration", f"""
with {TIMED_SQL}
select {ROW}, (epoch(dropoff_ts) - epoch(pickup_ts)) / 60 as trip_duration_minutes,
       cast(pickup_ts as date) as pickup_date, date_trunc('hour', pickup_ts) as pickup_hour from trips""")
def duration(spark: SparkSession, sf: str) -> DataFrame:
    df = clean.with_duration(shapes.timed_trips(spark, sf))
    df = clean.with_pickup_hour(clean.with_pickup_date(df))
    return ntz(df.select(*ROW_COLS, "trip_duration_minutes", "pickup_date", "pickup_hour"))


@query("lineage", "select extract(year from o_orderdate)::bigint as year, count(*) as n, count(*) as with_time from orders group by 1")
def lineage(spark: SparkSession, sf: str) -> DataFrame:
    """Each year's orders lie in files of their own; the name a row carries has to be one of its year's."""
    path = fresh_path(spark, "lineage")
    table(spark, sf, "orders").withColumn("year", F.year("o_orderdate").cast("bigint")).repartition("year").write.partitionBy(
        "year"
    ).parquet(path)
    files = sources.list_files(spark, f"{path}/*/*.parquet").select(
        "file_name", F.regexp_extract("path", "year=(\\d+)", 1).cast("bigint").alias("of_year")
    )
    df = clean.with_lineage(sources.read_parquet(spark, path))
    right = (F.col("source_file") == F.col("file_name")) & (F.col("year") == F.col("of_year"))
    return df.join(files, right).groupBy(F.col("year").cast("bigint").alias("year")).agg(
        F.count(F.lit(1)).alias("n"), F.count("ingested_at").alias("with_time")
    )


@query("row_ids", """
select count(*) as n, count(distinct (coalesce(a, -1), coalesce(b, -1), l_partkey)) as ids from (
  select case when l_suppkey % 2 = 0 then l_linenumber end as a, case when l_suppkey % 2 = 1 then l_linenumber end as b,
         l_partkey from lineitem)""")
def row_ids(spark: SparkSession, sf: str) -> DataFrame:
    """Ids from a key repeat exactly where the key does; a NULL in it has its place."""
    even = F.col("l_suppkey") % 2 == 0
    keyed = table(spark, sf, "lineitem").select(
        F.when(even, F.col("l_linenumber")).alias("a"), F.when(~even, F.col("l_linenumber")).alias("b"), "l_partkey"
    )
    return clean.with_row_id(keyed, "a", "b", "l_partkey").agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("trip_id").alias("ids")
    )


@query("last_n_months", """
select o_orderkey from orders
where o_orderdate >= (select cast(max(o_orderdate) - interval 3 month as date) from orders)""")
def last_n_months(spark: SparkSession, sf: str) -> DataFrame:
    return clean.last_n_months(table(spark, sf, "orders"), "o_orderdate", 3).select("o_orderkey")


@query("max_time", "select * from orders where o_orderdate = (select max(o_orderdate) from orders)")
def max_time(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders")
    return orders.filter(F.col("o_orderdate") == clean.max_time(orders, "o_orderdate"))


@query("between_dates", """
select o_orderkey, o_totalprice from orders
where o_orderdate >= timestamp '1998-01-01' and o_orderdate < timestamp '1998-02-01'""")
def between_dates(spark: SparkSession, sf: str) -> DataFrame:
    df = clean.between_dates(table(spark, sf, "orders"), "o_orderdate", "1998-01-01", "1998-02-01")
    return df.select("o_orderkey", "o_totalprice")


@query("for_run", "select o_orderkey, o_orderstatus as run_id from orders where o_orderstatus = 'F'")
def for_run(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders").select("o_orderkey", F.col("o_orderstatus").alias("run_id"))
    return clean.for_run(orders, "F")


@query("select_rename", """
select c_custkey as id, upper(c_name) as name, c_mktsegment as segment from customer""")
def select_rename(spark: SparkSession, sf: str) -> DataFrame:
    packed = table(spark, sf, "customer").select(
        F.struct(F.col("c_custkey").alias("id"), F.upper("c_name").alias("name"), "c_mktsegment", "c_acctbal").alias("d")
    )
    return packed.select("d.*").withColumnRenamed("c_mktsegment", "segment").drop("c_acctbal")


# -- scalar functions --------------------------------------------------------


@query("parse_ts", """
select event_id, case when event_type = 'error' then null else date_trunc('second', ts) end as parsed from events""")
def parse_times(spark: SparkSession, sf: str) -> DataFrame:
    text = F.when(F.col("event_type") == "error", "??").otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))
    return ntz(table(spark, sf, "events").select("event_id", parse_ts(text).alias("parsed")))


@query("parse_json_payload", """
select event_id, user_id, event_type, cast(round(value * 100) as bigint) as value from events""")
def parse_payload(spark: SparkSession, sf: str) -> DataFrame:
    parsed = parse_json_payload(shapes.log(spark, sf).select("value"), shapes.EVENT_PAYLOAD)
    return parsed.drop("ts", "zone")


@query("json_path", """
select event_id, cast(json_extract_string(props, '$.k') as double) as k,
       coalesce(json_extract_string(props, '$.missing'), json_extract_string(props, '$.k'), '') as first_key,
       0.0::double as fallback from events""")
def json_path(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").select(
        "event_id",
        json_double("props", "k").alias("k"),
        json_text("props", "missing", "k", default="").alias("first_key"),
        json_double("event_type", "k").alias("fallback"),
    )


@query("json_set", """
select event_id, cast(json_extract_string(props, '$.k') as int) as k, event_type as kind from events""")
def json_set_key(spark: SparkSession, sf: str) -> DataFrame:
    """A nested object is set beside the old key, then both are read back."""
    made = json_set("props", "seen", F.to_variant_object(F.struct("event_type", "user_id")))
    return table(spark, sf, "events").select("event_id", made.alias("p")).select(
        "event_id",
        F.get_json_object("p", "$.k").cast("int").alias("k"),
        F.get_json_object("p", "$.seen.event_type").alias("kind"),
    )


@query("fingerprint", "select doc_id, sha256(text) as fp from documents")
def fingerprints(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").select("doc_id", fingerprint("text").alias("fp"))


@query("text_or_empty", """
select doc_id, trim(coalesce(case when lang = 'en' then null else '  ' || source || ' ' end, '')) as t from documents""")
def empty_text(spark: SparkSession, sf: str) -> DataFrame:
    raw = F.when(F.col("lang") == "en", None).otherwise(F.concat(F.lit("  "), F.col("source"), F.lit(" ")))
    return table(spark, sf, "documents").select("doc_id", text_or_empty(raw).alias("t"))


@query("l2_normalize", """
select vec_id, cast(sum(x * x) as decimal(18, 4)) as norm from (
  select vec_id, unnest(list_transform(embedding, lambda v: v / sqrt(sq))) as x from (
    select vec_id, embedding::double[] as embedding,
           list_sum(list_transform(embedding::double[], lambda v: v * v)) as sq from embeddings))
group by 1""")
def unit_vectors(spark: SparkSession, sf: str) -> DataFrame:
    unit = table(spark, sf, "embeddings").select("vec_id", l2_normalize("embedding").alias("u"))
    norm = F.aggregate("u", F.lit(0.0), lambda a, x: a + x.cast("double") * x)
    return unit.select("vec_id", norm.cast("decimal(18,4)").alias("norm"))


# -- joins -------------------------------------------------------------------

_ENRICHED_SQL = f"""
with {TRIPS_SQL}, {ZONES_SQL}
select {ROW}, p.zone as pickup_zone, p.borough as pickup_borough, d.zone as dropoff_zone, d.borough as dropoff_borough
from trips left join zones p on pu = p.id left join zones d on dl = d.id"""


def _enriched(spark: SparkSession, sf: str, zones: DataFrame) -> DataFrame:
    rich = enrich.enrich_zones(shapes.trips(spark, sf), zones)
    return rich.select(*ROW_COLS, "pickup_zone", "pickup_borough", "dropoff_zone", "dropoff_borough")


@query("enrich_zones", _ENRICHED_SQL.replace("on pu = p.id", "on pu = p.id and p.id < 20").replace("on dl = d.id", "on dl = d.id and d.id < 20"))
def enrich_zones(spark: SparkSession, sf: str) -> DataFrame:
    """Some zones are missing in the lookup; their trips stay."""
    return _enriched(spark, sf, shapes.zones(spark, sf).filter(F.col("LocationID") < 20))


@query("enrich_zones_unhinted", _ENRICHED_SQL)
def enrich_zones_unhinted(spark: SparkSession, sf: str) -> DataFrame:
    """Every trip has its zones."""
    return _enriched(spark, sf, shapes.zones(spark, sf))


@query("pct_of", """
select 100.0::double * (select count(*) from labels) / nullif((select count(*) from documents), 0) as pct""")
def pct_of(spark: SparkSession, sf: str) -> DataFrame:
    return gold.pct_of(table(spark, sf, "labels"), table(spark, sf, "documents"))


@query("keep_ids", "select doc_id, lang from documents where doc_id in (select doc_id from labels)")
def keep_ids(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "lang")
    return sources.keep_ids(docs, table(spark, sf, "labels"), "doc_id")


# -- deduplication -----------------------------------------------------------


@query("dedup_lineitem", f"select {ROW}, l_shipdate from ({FIRST_LINE_SQL}) where rn = 1")
def dedup_lineitem(spark: SparkSession, sf: str) -> DataFrame:
    items = table(spark, sf, "lineitem").select(*ROW_COLS, "l_extendedprice", "l_shipdate")
    first = dedup.dedup(items, LINE_KEY, ["l_partkey", "l_suppkey", "l_extendedprice", "l_shipdate"])
    return first.select(*ROW_COLS, "l_shipdate")


@query("dedup_any", "select distinct l_orderkey, l_linenumber from lineitem")
def dedup_any(spark: SparkSession, sf: str) -> DataFrame:
    """Without an order any copy may survive; the keys are the same."""
    return dedup.dedup(table(spark, sf, "lineitem"), LINE_KEY).select(*LINE_KEY)


@query("dedup_against", """
select distinct lang, source from documents d
where not exists (select 1 from (select distinct lang, source from documents where n_chars < 300) t
                  where t.lang is not distinct from d.lang and t.source is not distinct from d.source)""")
def dedup_against(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("lang", "source", "n_chars")
    short = docs.filter("n_chars < 300")
    return dedup.dedup_against(docs.select("lang", "source"), short, ["lang", "source"]).distinct()


@query("dedup_report", """
select count(*) as before_n, count(distinct (l_orderkey, l_linenumber)) as after_n,
       count(*) - count(distinct (l_orderkey, l_linenumber)) as removed from lineitem""")
def dedup_report(spark: SparkSession, sf: str) -> DataFrame:
    return dedup.dedup_report(table(spark, sf, "lineitem"), LINE_KEY)


@query("count_duplicates", """
select count(*) as dup_keys from (select 1 from lineitem group by l_orderkey, l_linenumber having count(*) > 1)""")
def count_duplicates(spark: SparkSession, sf: str) -> DataFrame:
    return dedup.count_duplicates(table(spark, sf, "lineitem"), LINE_KEY)


@query("keys_over", "select l_orderkey, count(*) as n from lineitem group by 1 having count(*) > 2")
def keys_over(spark: SparkSession, sf: str) -> DataFrame:
    return dedup.keys_over(table(spark, sf, "lineitem"), ["l_orderkey"], 2)


# -- aggregates --------------------------------------------------------------


@query("gold_zone_hour_window", f"""
with {LOG_SQL}
select n_name as pickup_zone, date_trunc('hour', ts) as pickup_hour, count(*) as trip_count,
       sum(cents)::double / count(cents) as avg_fare
from log left join nation on user_id % 25 = n_nationkey group by 1, 2""")
def gold_zone_hour_window(spark: SparkSession, sf: str) -> DataFrame:
    return ntz(gold.gold_zone_hour_window(_zoned_events(spark, sf), fare="cents"))


def _zoned_events(spark: SparkSession, sf: str) -> DataFrame:
    events = table(spark, sf, "events").select(
        shapes.ts("ts").alias("pickup_ts"),
        (F.col("user_id") % 25).cast("int").alias("PULocationID"),
        shapes.cents("value").alias("cents"),
        F.col("user_id"),
    )
    return enrich.enrich_zones(events, shapes.zones(spark, sf), dropoff=None)


@query("gold_zone_hour", f"""
with {LOG_SQL}
select n_name as pickup_zone, date_trunc('hour', ts) as pickup_hour, count(*) as trips_count,
       sum(cents)::double / count(cents) as avg_fare_amount, sum(user_id)::double / count(user_id) as avg_trip_distance
from log left join nation on user_id % 25 = n_nationkey group by 1, 2""")
def gold_zone_hour(spark: SparkSession, sf: str) -> DataFrame:
    df = _zoned_events(spark, sf)
    return ntz(gold.gold_zone_period(df, "pickup_zone", fare="cents", distance="user_id"))


_GOLD_DAY_SQL = f"""
with {TRIPS_SQL}, {ZONES_SQL},
first_trips as (
  select * from (
    select *, row_number() over (
      partition by l_orderkey, l_linenumber order by l_partkey, l_suppkey, fare_amount, dropoff_ts) as rn
    from trips
    where trip_distance >= 0 and passenger_count >= 0 and pickup_ts is not null and dropoff_ts is not null
  ) where rn = 1)
select zone as pickup_zone, date_trunc('day', pickup_ts)::timestamp as pickup_day, count(*) as trips_count,
       sum(fare_amount)::double / count(fare_amount) as avg_fare_amount,
       sum(trip_distance) / count(trip_distance) as avg_trip_distance
from first_trips left join zones on pu = id group by 1, 2"""


@query("gold_zone_day", _GOLD_DAY_SQL)
def gold_zone_day(spark: SparkSession, sf: str) -> DataFrame:
    """Clean, deduplicate, look up the pickup zone, aggregate per day.

    The rules on the line itself and the deduplication come before the join, so
    copies of a line do not travel further than their first shuffle.
    """
    items = shapes.lines(spark, sf).filter(
        (F.col("trip_distance") >= 0) & (F.col("passenger_count") >= 0) & F.col("dropoff_ts").isNotNull()
    )
    unique = dedup.dedup(items, LINE_KEY, LINE_ORDER)
    kept = clean.clean_basic(shapes.pickup_trips(spark, sf, unique))
    rich = enrich.enrich_zones(kept, shapes.zones(spark, sf), dropoff=None)
    return ntz(gold.gold_zone_period(rich, "pickup_zone", unit="day"))


@query("gold_preview", f"""
with {LOG_SQL}
select topic, date_trunc('hour', ts) as hour, count(*) as n from log group by 1, 2 order by 2, 1 limit 20""")
def gold_preview(spark: SparkSession, sf: str) -> DataFrame:
    per_hour = shapes.log(spark, sf).groupBy("topic", F.date_trunc("hour", "timestamp").alias("hour")).agg(
        F.count(F.lit(1)).alias("n")
    )
    return ntz(gold.preview(per_hour, ["hour", "topic"], 20))


@query("count_by_topic", f"with {LOG_SQL} select topic, count(*) as cnt from log group by topic")
def count_by_topic(spark: SparkSession, sf: str) -> DataFrame:
    return gold.count_by(shapes.log(spark, sf), "topic")


@query("row_count", "select count(*) as n from lineitem")
def row_count(spark: SparkSession, sf: str) -> DataFrame:
    return gold.row_count(table(spark, sf, "lineitem"))


@query("null_rates", """
select coalesce(count(*) filter (where event_type = 'error' or value is null)::double / nullif(count(*), 0), 0) as rate_value,
       coalesce(count(*) filter (where props is null)::double / nullif(count(*), 0), 0) as rate_props from events""")
def null_rates(spark: SparkSession, sf: str) -> DataFrame:
    df = table(spark, sf, "events").withColumn("value", F.when(F.col("event_type") != "error", F.col("value")))
    return gold.null_rates(df, ["value", "props"])


@query("distinct_count", "select count(distinct source) as sources from documents")
def distinct_count(spark: SparkSession, sf: str) -> DataFrame:
    return gold.distinct_count(table(spark, sf, "documents"), "source", "sources")


@query("pct_where", """
select 100.0::double * count(*) filter (where quality = 1) / nullif(count(*), 0) as pct from labels""")
def pct_where(spark: SparkSession, sf: str) -> DataFrame:
    return gold.pct_where(table(spark, sf, "labels"), F.col("quality") == 1)


@query("metrics_long", """
select null::varchar as run_id, 'docs' as metric_name, count(*)::double as metric_value from documents
union all select null, 'langs', count(distinct lang)::double from documents
union all select null, 'chars', sum(n_chars)::double from documents""")
def metrics_long(spark: SparkSession, sf: str) -> DataFrame:
    wide = table(spark, sf, "documents").agg(
        F.count(F.lit(1)).alias("docs"), F.count_distinct("lang").alias("langs"), F.sum("n_chars").alias("chars")
    )
    return gold.metrics_long(wide)


@query("take_first", "select o_orderkey, o_totalprice from orders order by o_totalprice desc, o_orderkey limit 50")
def take_first(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    return sources.take_first(orders, 50, F.desc("o_totalprice"), "o_orderkey")


# -- event-log records -------------------------------------------------------


@query("record_meta", f"""
with {LOG_SQL}
select topic, part as partition, off as offset, ts as kafka_time, cast(user_id as varchar) as key from log""")
def record_meta(spark: SparkSession, sf: str) -> DataFrame:
    return ntz(sources.with_record_meta(shapes.log(spark, sf), key=True).drop("value"))


@query("in_log_order", f'with {LOG_SQL} select part as partition, off as offset from log order by 1, 2')
def in_log_order(spark: SparkSession, sf: str) -> DataFrame:
    return sources.in_log_order(shapes.log(spark, sf).select("partition", "offset"))


@query("offset_progress", f"""
with {LOG_SQL} select topic, part as partition, max(off) as max_offset, count(*) as n from log group by 1, 2""")
def offset_progress(spark: SparkSession, sf: str) -> DataFrame:
    return gold.offset_progress(shapes.log(spark, sf))


@query("layer_counts", """
select (select count(*) from events) as bronze, (select count(distinct user_id) from events) as silver,
       (select count(distinct event_type) from events) as gold""")
def layer_counts(spark: SparkSession, sf: str) -> DataFrame:
    log = shapes.log(spark, sf)
    return gold.layer_counts(bronze=log, silver=log.select("key").distinct(), gold=log.select("topic").distinct())


# -- merges ------------------------------------------------------------------
# Old lines are the target, lines shipped from a day on are the source.

SPLIT = "1998-07-01"
_SIDES_SQL = f"""
firsts as (
  select l_orderkey, l_linenumber, l_partkey, l_quantity, l_shipdate >= timestamp '{SPLIT}' as is_new,
         row_number() over (
           partition by l_orderkey, l_linenumber, l_shipdate >= timestamp '{SPLIT}'
           order by l_partkey, l_suppkey, l_extendedprice, l_shipdate) as rn
  from lineitem),
tgt as (select l_orderkey, l_linenumber, l_partkey, l_quantity from firsts where rn = 1 and not is_new),
src as (select l_orderkey, l_linenumber, l_partkey, l_quantity from firsts where rn = 1 and is_new)"""
SIDE_COLS = [*LINE_KEY, "l_partkey", "l_quantity"]


def _side(spark: SparkSession, sf: str, new: bool) -> DataFrame:
    """One side as a stored table, as a merge finds it."""
    day = F.lit(SPLIT).cast("timestamp_ntz")
    items = table(spark, sf, "lineitem").select(*SIDE_COLS, "l_suppkey", "l_extendedprice", "l_shipdate")
    items = items.filter(F.col("l_shipdate") >= day if new else F.col("l_shipdate") < day)
    order = ["l_partkey", "l_suppkey", "l_extendedprice", "l_shipdate"]
    return staged(dedup.dedup(items, LINE_KEY, order).select(*SIDE_COLS), "side")


@query("merge_classify", f"""
with {_SIDES_SQL}
select l_orderkey, l_linenumber,
       case when s.l_partkey is null then 'target_only' when t.l_partkey is null then 'source_only'
            else 'matched' end as merge_class
from tgt t full join src s using (l_orderkey, l_linenumber)""")
def merge_classify(spark: SparkSession, sf: str) -> DataFrame:
    return merge.classify_merge(_side(spark, sf, False), _side(spark, sf, True), LINE_KEY)


@query("merge_upsert", f"""
with {_SIDES_SQL}
select l_orderkey, l_linenumber, coalesce(s.l_partkey, t.l_partkey) as l_partkey,
       case when s.l_partkey is not null then s.l_quantity else t.l_quantity end as l_quantity
from tgt t full join src s using (l_orderkey, l_linenumber)""")
def merge_upsert(spark: SparkSession, sf: str) -> DataFrame:
    return merge.merge_upsert(_side(spark, sf, False), _side(spark, sf, True), LINE_KEY)


@query("insert_if_absent", f"""
with {_SIDES_SQL}
select l_orderkey, l_linenumber, coalesce(t.l_partkey, s.l_partkey) as l_partkey,
       case when t.l_partkey is not null then t.l_quantity else s.l_quantity end as l_quantity
from tgt t full join src s using (l_orderkey, l_linenumber)""")
def insert_if_absent(spark: SparkSession, sf: str) -> DataFrame:
    return merge.insert_if_absent(_side(spark, sf, False), _side(spark, sf, True), LINE_KEY, ["l_partkey"])


@query("update_by_key", """
select c_custkey, c_name, case when o.o_custkey is null then c_acctbal else o.top end as c_acctbal
from customer left join (select o_custkey, max(o_totalprice) as top from orders group by 1) o on c_custkey = o_custkey""")
def update_by_key(spark: SparkSession, sf: str) -> DataFrame:
    target = table(spark, sf, "customer").select("c_custkey", "c_name", "c_acctbal")
    patch = table(spark, sf, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.max("o_totalprice").alias("c_acctbal")
    )
    return merge.update_by_key(target, patch, "c_custkey", check=False)


@query("delete_where", "select event_id from events where not coalesce(ts >= timestamp '2024-01-20', false)")
def delete_where(spark: SparkSession, sf: str) -> DataFrame:
    day = F.lit("2024-01-20").cast("timestamp_ntz")
    return merge.delete_where(table(spark, sf, "events"), F.col("ts") >= day).select("event_id")


@query("insert_rows", """
select c_custkey, c_name, c_nationkey from customer
union all select -1, 'ATLANTIS', 1 union all select -2, 'LEMURIA', null""")
def insert_rows(spark: SparkSession, sf: str) -> DataFrame:
    rows = [{"c_custkey": -1, "c_name": "ATLANTIS", "c_nationkey": 1}, {"c_custkey": -2, "c_name": "LEMURIA"}]
    return merge.insert_rows(table(spark, sf, "customer").select("c_custkey", "c_name", "c_nationkey"), rows)


# -- sources and sinks, by writing and reading back --------------------------


@query("read_parquet_glob", """
select c_custkey as id, c_name as name from customer union all select s_suppkey, s_name from supplier""")
def read_parquet_glob(spark: SparkSession, sf: str) -> DataFrame:
    path = fresh_path(spark, "glob")
    for name, key, text in (("customer", "c_custkey", "c_name"), ("supplier", "s_suppkey", "s_name")):
        part = table(spark, sf, name).select(F.col(key).alias("id"), F.col(text).alias("name"))
        sinks.append(part, f"{path}/{name}.parquet")
    return sources.read_parquet(spark, f"{path}/*.parquet")


@query("read_csv_dir", "select o_orderkey, o_custkey, o_totalprice, o_orderdate from orders")
def read_csv_dir(spark: SparkSession, sf: str) -> DataFrame:
    path = fresh_path(spark, "csv")
    table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate").write.option(
        "header", True
    ).csv(path)
    schema = "o_orderkey bigint, o_custkey bigint, o_totalprice double, o_orderdate timestamp_ntz"
    return sources.read_csv_dir(spark, path, schema)


@query("read_csv_inferred", """
select count(*) as n, sum(c_custkey) as ids, count(c_name) as names, 'int,string,double' as types from customer""")
def read_csv_inferred(spark: SparkSession, sf: str) -> DataFrame:
    path = fresh_path(spark, "csv")
    table(spark, sf, "customer").select("c_custkey", "c_name", "c_acctbal").write.option("header", True).csv(path)
    df = sources.read_csv_dir(spark, path)
    types = ",".join(kind for _, kind in df.dtypes)
    return df.agg(
        F.count(F.lit(1)).alias("n"), F.sum("c_custkey").cast("bigint").alias("ids"), F.count("c_name").alias("names"),
        F.lit(types).alias("types"),
    )


_MONTH = "'trips-' || strftime({}, '%Y-%m') || '.parquet'"


@query("new_files", f"""
select distinct {_MONTH.format('l_shipdate')} as file_name from lineitem
except select {_MONTH.format('o_orderdate')} from orders""")
def new_files(spark: SparkSession, sf: str) -> DataFrame:
    """Months with shipments are the inbox, months with orders the manifest."""

    def files(name: str, ts: str) -> DataFrame:
        month = F.date_format(ts, "yyyy-MM")
        return table(spark, sf, name).select(
            F.concat(F.lit("trips-"), month, F.lit(".parquet")).alias("file_name")
        ).distinct()

    return sources.new_files(files("lineitem", "l_shipdate"), files("orders", "o_orderdate"), "file_name")


@query("append_parquet", "select o_orderkey, o_totalprice from orders union all select o_orderkey, o_totalprice from orders")
def append_parquet(spark: SparkSession, sf: str) -> DataFrame:
    """Two appends, and a third one of no rows that is skipped."""
    path = fresh_path(spark, "append")
    orders = table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    sinks.append(orders, path)
    sinks.append_nonempty(orders, path)
    sinks.append_nonempty(orders.filter("o_orderkey is null"), path)
    return sources.read_parquet(spark, path)


@query("create_or_append", """
select c_custkey, c_nationkey from customer union all select c_custkey, c_nationkey from customer""")
def create_or_append(spark: SparkSession, sf: str) -> DataFrame:
    """The second batch has its columns in another order."""
    path = fresh_path(spark, "table")
    name = "tw_" + path.rsplit("-", 1)[1]
    customer = table(spark, sf, "customer").select("c_custkey", "c_nationkey")
    sinks.create_or_append(customer, name, path)
    sinks.create_or_append(customer.select("c_nationkey", "c_custkey"), name, path)
    return sources.read_table(spark, name)


@query("overwrite_partitions", """
select year(o_orderdate) as order_year, count(*) as n,
       sum(case when o_orderdate >= timestamp '1999-01-01' then 2 else 1 end) as weight from orders group by 1""")
def overwrite_partitions(spark: SparkSession, sf: str) -> DataFrame:
    """All years are written, then a batch of the later years replaces only those."""
    path = fresh_path(spark, "partitions")
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderdate", F.year("o_orderdate").alias("order_year"))
    sinks.overwrite_partitions(orders.withColumn("weight", F.lit(1)), path, "order_year")
    later = orders.filter(F.col("o_orderdate") >= F.lit("1999-01-01").cast("timestamp_ntz"))
    sinks.overwrite_partitions(later.withColumn("weight", F.lit(2)), path, "order_year")
    return sources.read_parquet(spark, path).groupBy(F.col("order_year").cast("bigint").alias("order_year")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("weight").alias("weight")
    )


@query("overwrite", "select p_partkey, p_size from part")
def overwrite(spark: SparkSession, sf: str) -> DataFrame:
    path = fresh_path(spark, "overwrite")
    part = table(spark, sf, "part").select("p_partkey", "p_size")
    sinks.overwrite(part.withColumn("p_size", F.lit(0)), path)
    sinks.overwrite(part, path)
    return sources.read_parquet(spark, path)


@query("day_table", """
select cast(ts as date) as ts_day, count(*) as n from events
where ts >= timestamp '2024-01-10' and ts < timestamp '2024-01-20' group by 1""")
def day_table(spark: SparkSession, sf: str) -> DataFrame:
    """A table partitioned by day; the date range prunes its partitions."""
    path = fresh_path(spark, "days")
    name = "tw_" + path.rsplit("-", 1)[1]
    events = table(spark, sf, "events").select("event_id", "ts")
    sinks.create_day_table(spark, name, events.schema, "ts", path)
    sinks.create_or_append(sinks.with_day(events, "ts"), name)
    days = clean.between_dates(sources.read_table(spark, name), "ts_day", "2024-01-10", "2024-01-20")
    return days.groupBy("ts_day").agg(F.count(F.lit(1)).alias("n"))


@query("land_objects", "select page_id, sha256(html) as source_fingerprint, octet_length(encode(html)) as length from pages")
def land_objects(spark: SparkSession, sf: str) -> DataFrame:
    path = fresh_path(spark, "objects")
    pages = table(spark, sf, "pages").select("page_id", F.col("html").cast("binary").alias("content"))
    sinks.land_objects(pages, path)
    return sources.read_parquet(spark, path).select(
        "page_id", "source_fingerprint", F.octet_length("content").cast("bigint").alias("length")
    )


def _landed_documents(spark: SparkSession, sf: str) -> str:
    """Documents as text objects of bounded size, one JSON text per line."""
    path = fresh_path(spark, "texts")
    docs = table(spark, sf, "documents").select(F.to_json(F.struct("doc_id", "text")))
    docs.write.option("maxRecordsPerFile", 500).text(path)
    return path


_DOCUMENT_FP_SQL = "select doc_id, sha256(text) as fp from documents"


def _document_fp(lines: DataFrame) -> DataFrame:
    doc = F.from_json("line", "doc_id bigint, text string")
    return lines.filter("line <> ''").select(doc.alias("d")).select("d.doc_id", fingerprint("d.text").alias("fp"))


@query("read_texts", _DOCUMENT_FP_SQL)
def read_texts(spark: SparkSession, sf: str) -> DataFrame:
    texts = sources.read_texts(spark, f"{_landed_documents(spark, sf)}/*.txt")
    return _document_fp(texts.select(F.explode(F.split("text", "\n")).alias("line")))


@query("read_objects", _DOCUMENT_FP_SQL)
def read_objects(spark: SparkSession, sf: str) -> DataFrame:
    blobs = sources.read_objects(spark, f"{_landed_documents(spark, sf)}/*.txt")
    return _document_fp(blobs.select(F.explode(F.split(F.decode("content", "UTF-8"), "\n")).alias("line")))


# -- pipelines ---------------------------------------------------------------


def _move_numbered(spark: SparkSession, folder: str, to: str) -> None:
    """Move the part files of a folder to another one, as trips-0, trips-1 and so on."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    files = path(to).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    files.mkdirs(path(to))
    parts = sorted(f.getPath().getName() for f in files.listStatus(path(folder)) if f.getPath().getName().startswith("part-"))
    for i, name in enumerate(parts):
        files.rename(path(f"{folder}/{name}"), path(f"{to}/trips-{i}.parquet"))


@query("ingest_inbox", """
select o_orderkey, n_name as pickup_zone, cast(o_orderdate as date) as pickup_date from orders
join customer on o_custkey = c_custkey left join nation on c_nationkey = n_nationkey""")
def ingest_inbox(spark: SparkSession, sf: str) -> DataFrame:
    """Files of equal names arrive in two folders; three runs read each file once."""
    root = fresh_path(spark, "inbox")
    orders = shapes.pickups(spark, sf).select(
        "o_orderkey",
        "pickup_ts",
        F.col("pickup_ts").alias("dropoff_ts"),
        F.lit(1).alias("passenger_count"),
        F.lit(0.0).alias("trip_distance"),
        F.lit(1.0).alias("fare_amount"),
        "PULocationID",
        F.col("PULocationID").alias("DOLocationID"),
    )
    zones = shapes.zones(spark, sf)
    day = F.lit("1998-01-01").cast("timestamp")
    staging = f"{root}/staging"
    for folder, batch in (("a", F.col("pickup_ts") < day), ("b", F.col("pickup_ts") >= day), (None, None)):
        if folder:
            sinks.overwrite(orders.filter(batch), staging)
            _move_numbered(spark, staging, f"{root}/inbox/{folder}")
        trip_plans.ingest_inbox(
            spark, f"{root}/inbox/*/*.parquet", f"{root}/manifest", f"{root}/out", zones, ["o_orderkey"], ["pickup_ts"]
        )
    return sources.read_parquet(spark, f"{root}/out").select("o_orderkey", "pickup_zone", "pickup_date")


@query("silver_gold_trips", f"""
with {TRIPS_SQL}, {ZONES_SQL}
select zone as pickup_zone, date_trunc('hour', pickup_ts) as pickup_hour, count(*) as trips_count,
       sum(fare_amount)::double / count(fare_amount) as avg_fare_amount, sum(trip_distance) / count(trip_distance) as avg_trip_distance
from trips left join zones on pu = id
where pickup_ts < dropoff_ts and trip_distance > 0 and fare_amount > 0 and passenger_count between 1 and 6
group by 1, 2""")
def silver_gold_trips(spark: SparkSession, sf: str) -> DataFrame:
    silver = trip_plans.silver_trips(shapes.trips(spark, sf), shapes.zones(spark, sf))
    return ntz(trip_plans.gold_trips(silver))


@query("sketch_ranges", """
select date_trunc('week', ts) as week, count(*) as n, true as users_near, true as median_near from events group by 1""")
def sketch_ranges(spark: SparkSession, sf: str) -> DataFrame:
    """Sketches per day, stored and merged to weeks; their estimates are held against the exact numbers."""
    events = table(spark, sf, "events").select("user_id", "value", shapes.ts("ts").alias("t"))
    days = staged(sketches.sketched(events.withColumn("day", F.to_date("t")), ["day"], ["user_id"], ["value"]), "sketches")
    weeks = sketches.merged(days.withColumn("week", F.date_trunc("week", "day")), ["week"])
    guess = sketches.estimates(weeks)
    rows = events.withColumn("week", F.date_trunc("week", "t")).join(F.broadcast(guess.select("week", "value_p50")), "week")
    exact = rows.groupBy("week").agg(
        F.count_distinct("user_id").alias("users"), F.avg((F.col("value") <= F.col("value_p50")).cast("int")).alias("rank")
    )
    held = guess.join(exact, "week").select(
        "week",
        "n",
        (F.abs(F.col("distinct_user_id") - F.col("users")) <= 0.05 * F.col("users")).alias("users_near"),
        F.col("rank").between(0.45, 0.55).alias("median_near"),
    )
    return ntz(held)
