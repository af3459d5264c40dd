"""Snapshots, ledger, quality, alerts, audits and runs."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.operators import dedup, history, quality, runs
from tidewater.operators.gold import most_recent
from tidewater.plans.replicate import Replication, replica, replicate
from tidewater.session import fresh_path, staged
from tidewater.sources import read_parquet
from tidewater.workloads import shapes
from tidewater.workloads.registry import query
from tidewater.workloads.shapes import LEDGER_SQL, ntz, table

# -- ledger ------------------------------------------------------------------


@query("snapshot_before", f"""
with {LEDGER_SQL},
days as (
  select table_name, execution_date, max(snapshot_id) as snapshot_id from ledger group by 1, 2)
select table_name, execution_date,
       lag(execution_date) over w as prev_date, lag(snapshot_id) over w as snapshot_id
from days window w as (partition by table_name order by execution_date)""")
def snapshot_before(spark: SparkSession, sf: str) -> DataFrame:
    """Asks for every table and date of the ledger."""
    ledger = shapes.ledger(spark, sf)
    return history.snapshot_before(ledger, ledger.select("table_name", "execution_date").distinct())


@query("snapshot_before_shipping", f"""
with {LEDGER_SQL},
asked as (select distinct o_orderpriority as table_name, cast(l_shipdate as date) as execution_date
          from lineitem join orders on l_orderkey = o_orderkey),
days as (select table_name, execution_date, max(snapshot_id) as snapshot_id from ledger group by 1, 2)
select a.table_name, a.execution_date, d.execution_date as prev_date, d.snapshot_id
from asked a asof left join days d
  on a.table_name = d.table_name and a.execution_date > d.execution_date""")
def snapshot_before_shipping(spark: SparkSession, sf: str) -> DataFrame:
    """Asks for dates that the ledger need not have."""
    orders = table(spark, sf, "orders").select("o_orderkey", F.col("o_orderpriority").alias("table_name"))
    asked = table(spark, sf, "lineitem").select("l_orderkey", F.to_date("l_shipdate").alias("execution_date")).join(
        orders, F.col("l_orderkey") == F.col("o_orderkey")
    ).select("table_name", "execution_date").distinct()
    return history.snapshot_before(shapes.ledger(spark, sf), asked)


@query("ledger_stats", f"""
with {LEDGER_SQL}
select table_name, count(*) as merges, to_timestamp(max(snapshot_id))::timestamp as last_merge from ledger group by 1""")
def ledger_stats(spark: SparkSession, sf: str) -> DataFrame:
    return ntz(history.ledger_stats(shapes.ledger(spark, sf)))


@query("latest_snapshot", "select o_orderkey as snapshot_id from orders order by o_orderdate desc, o_orderkey desc limit 1")
def latest_snapshot(spark: SparkSession, sf: str) -> DataFrame:
    commits = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("snapshot_id"), shapes.ts("o_orderdate").alias("committed_at")
    )
    return history.latest_snapshot(commits)


# -- states ------------------------------------------------------------------


def _customers(spark: SparkSession, sf: str, balance) -> DataFrame:
    return table(spark, sf, "customer").select("c_custkey", balance.alias("c_acctbal"))


def _spent(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.max("o_totalprice").alias("c_acctbal")
    )


@query("rollback_state", "select c_custkey, c_acctbal from customer")
def rollback_state(spark: SparkSession, sf: str) -> DataFrame:
    """A bad state is committed, then the one before is current again."""
    root = fresh_path(spark, "history")
    good = history.commit_state(spark, root, _customers(spark, sf, F.col("c_acctbal")))
    history.commit_state(spark, root, _customers(spark, sf, F.lit(0.0)))
    history.rollback(spark, root, good)
    return history.state_at(spark, root, history.current_snapshot_id(spark, root))


_BACKFILLED_SQL = """
select c_custkey, coalesce(o.top, c_acctbal) as c_acctbal
from customer left join (select o_custkey, max(o_totalprice) as top from orders group by 1) o on c_custkey = o_custkey
union all select o_custkey, max(o_totalprice) from orders where o_custkey is null group by 1"""


@query("stateful_merge_changes", _BACKFILLED_SQL)
def stateful_merge_changes(spark: SparkSession, sf: str) -> DataFrame:
    """The same backfill on a table of which only the merged batches are stored."""
    root, ledger = fresh_path(spark, "history"), fresh_path(spark, "ledger")
    for day, source in (
        (date(2024, 5, 1), _customers(spark, sf, F.col("c_acctbal"))),
        (date(2024, 5, 9), _customers(spark, sf, F.lit(-1.0))),
        (date(2024, 5, 5), _spent(spark, sf)),
    ):
        made = history.stateful_merge_changes(spark, root, source, ["c_custkey"], "customer", day, ledger)
    return history.state_at_changes(spark, root, ["c_custkey"], made)


@query("stateful_merge", _BACKFILLED_SQL)
def stateful_merge(spark: SparkSession, sf: str) -> DataFrame:
    """A backfill for the 5th starts from the state of the 1st and so drops what the 9th had merged."""
    root, ledger = fresh_path(spark, "history"), fresh_path(spark, "ledger")
    for day, source in (
        (date(2024, 5, 1), _customers(spark, sf, F.col("c_acctbal"))),
        (date(2024, 5, 9), _customers(spark, sf, F.lit(-1.0))),
        (date(2024, 5, 5), _spent(spark, sf)),
    ):
        history.stateful_merge(spark, root, source, ["c_custkey"], "customer", day, ledger)
    return history.state_at(spark, root, history.current_snapshot_id(spark, root))


@query("recorded_snapshots", """
select 'customer' as table_name, cast(d as date) as execution_date, cast(s as bigint) as snapshot_id
from (values ('2024-05-01', 1), ('2024-05-09', 2)) v(d, s)
where (select count(*) from customer) > 0""")
def recorded_snapshots(spark: SparkSession, sf: str) -> DataFrame:
    root, ledger = fresh_path(spark, "history"), fresh_path(spark, "ledger")
    for day in (date(2024, 5, 1), date(2024, 5, 9)):
        source = _customers(spark, sf, F.col("c_acctbal"))
        history.stateful_merge(spark, root, source, ["c_custkey"], "customer", day, ledger)
    return history.read_ledger(spark, ledger).drop("recorded_at")


@query("state_from_changes", """
select o_custkey, o_orderkey, snapshot_id from (
  select o_custkey, o_orderkey, year(o_orderdate) as snapshot_id,
         row_number() over (
           partition by o_custkey, case when o_custkey is null then year(o_orderdate) end
           order by o_orderdate desc, o_orderkey desc) as rn
  from orders where year(o_orderdate) <= 1999) where rn = 1""")
def state_from_changes(spark: SparkSession, sf: str) -> DataFrame:
    """A change log with one batch per year, as of 1999."""
    orders = table(spark, sf, "orders").select(
        "o_custkey", "o_orderkey", "o_orderdate", F.year("o_orderdate").cast("bigint").alias("snapshot_id")
    )
    batches = dedup.latest_per_key(orders, ["o_custkey", "snapshot_id"], ["o_orderdate", "o_orderkey"])
    return history.state_from_changes(batches, ["o_custkey"], 1999).drop("o_orderdate")


@query("replicate", "select c_custkey, c_name, c_acctbal from customer")
def run_replication(spark: SparkSession, sf: str) -> DataFrame:
    """Two runs of a whole replication from CSV files."""
    root = fresh_path(spark, "replica")
    columns = table(spark, sf, "customer").select("c_custkey", "c_name", "c_acctbal")
    columns.write.option("header", True).csv(f"{root}/source")
    cfg = Replication(
        "customer", "c_custkey", f"{root}/source", f"{root}/history", f"{root}/ledger", ["c_name"],
        f"{root}/alerts", "c_custkey bigint, c_name string, c_acctbal double",
    )
    for day in (date(2024, 5, 1), date(2024, 5, 2)):
        _, made = replicate(spark, cfg, day)
    return replica(spark, cfg, made)


@query("replicate_batches", "select c_custkey, c_name, c_acctbal from customer")
def run_replication_by_batches(spark: SparkSession, sf: str) -> DataFrame:
    """A first load with other balances, then two runs with a part of the customers each; only batches are written."""
    root = fresh_path(spark, "replica")
    columns = table(spark, sf, "customer").select("c_custkey", "c_name", "c_acctbal")
    odd = F.col("c_custkey") % 2 == 1
    loads = [columns.withColumn("c_acctbal", F.lit(0.0)), columns.filter(odd), columns.filter(~odd)]
    for day, load in enumerate(loads, 1):
        load.write.option("header", True).csv(f"{root}/source-{day}")
        cfg = Replication(
            "customer", "c_custkey", f"{root}/source-{day}", f"{root}/history", f"{root}/ledger", ["c_name"],
            f"{root}/alerts", "c_custkey bigint, c_name string, c_acctbal double", "batches",
        )
        _, made = replicate(spark, cfg, date(2024, 5, day))
    return replica(spark, cfg, made)


# -- quality -----------------------------------------------------------------


def _holes(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "lineitem").select(
        "l_orderkey",
        F.when(F.col("l_returnflag") != "R", F.col("l_returnflag")).alias("l_returnflag"),
        "l_linestatus",
    )


@query("pre_audit", """
with f as (
  select count(*) as n, count(*) filter (where l_returnflag = 'R')::double / count(*) as rate,
         (select count(*) from (select 1 from lineitem group by l_orderkey having count(*) > 1)) as dups
  from lineitem)
select 'lineitem' as table_name, 'freshness' as "check", 'OK' as status, n::double as value, null::varchar as detail from f
union all select 'lineitem', 'volume', 'OK', n::double, null from f
union all select 'lineitem', 'completeness', case when rate > 0.01 then 'WARNING' else 'OK' end, rate, 'l_returnflag' from f
union all select 'lineitem', 'consistency', case when dups > 0 then 'CRITICAL' else 'OK' end, dups::double, 'l_orderkey' from f""")
def pre_audit(spark: SparkSession, sf: str) -> DataFrame:
    cfg = quality.TableChecks("lineitem", "l_orderkey", ["l_linestatus", "l_returnflag"])
    return quality.pre_audit(_holes(spark, sf), cfg)


@query("check_freshness", """
select 'events' as table_name, case when count(*) = 0 then 'CRITICAL' else 'OK' end as status,
       count(*)::double as value from events""")
def check_freshness(spark: SparkSession, sf: str) -> DataFrame:
    return quality.check_freshness(table(spark, sf, "events"), "events")


@query("check_volume", """
select 'supplier' as table_name, case when count(*) < 500 then 'CRITICAL' else 'OK' end as status,
       count(*)::double as value from supplier""")
def check_volume(spark: SparkSession, sf: str) -> DataFrame:
    return quality.check_volume(table(spark, sf, "supplier"), "supplier", 500)


@query("check_sla", """
select 'events' as table_name,
       case when (epoch(timestamp '2024-02-01') - floor(epoch(max(ts)))) / 3600 > 6 then 'CRITICAL' else 'OK' end as status,
       (epoch(timestamp '2024-02-01') - floor(epoch(max(ts)))) / 3600 as value from events""")
def check_sla(spark: SparkSession, sf: str) -> DataFrame:
    now = F.lit("2024-02-01 00:00:00")
    return quality.check_sla(table(spark, sf, "events"), "events", "ts", 6, now)


@query("check_completeness", """
select 'lineitem' as table_name, case when rate > 0.01 then 'WARNING' else 'OK' end as status, rate as value,
       'l_returnflag' as worst_column
from (select count(*) filter (where l_returnflag = 'R')::double / count(*) as rate from lineitem)""")
def check_completeness(spark: SparkSession, sf: str) -> DataFrame:
    return quality.check_completeness(_holes(spark, sf), "lineitem", ["l_linestatus", "l_returnflag"])


@query("check_unique", """
select 'orders' as table_name, case when count(*) > 0 then 'CRITICAL' else 'OK' end as status, count(*)::double as value
from (select 1 from orders group by o_orderkey having count(*) > 1)""")
def check_unique(spark: SparkSession, sf: str) -> DataFrame:
    return quality.check_unique(table(spark, sf, "orders"), "orders", ["o_orderkey"])


@query("post_audit", """
select 'CRITICAL' as severity, '#data-incidents' as channel, 'lineitem' as table_name, true as pages,
       count(*)::varchar || ' values of l_orderkey occur more than once' as message
from (select 1 from lineitem group by l_orderkey having count(*) > 1)""")
def post_audit(spark: SparkSession, sf: str) -> DataFrame:
    """The gate stops the run; the alert it left is the result."""
    path = fresh_path(spark, "alerts")
    try:
        quality.post_audit(table(spark, sf, "lineitem"), quality.TableChecks("lineitem", "l_orderkey"), path)
    except quality.DataQualityError:
        return read_parquet(spark, path).drop("ts")
    raise AssertionError("repeated keys passed the gate")


def _problems(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").filter("event_type = 'error'").select(
        shapes.ts("ts").alias("ts"),
        F.when(F.col("value") > 100, "CRITICAL").otherwise("WARNING").alias("severity"),
        F.concat(F.lit("t"), F.col("user_id")).alias("table_name"),
        F.col("event_id").cast("string").alias("message"),
    )


_ALERTS_SQL = """
alerts as (
  select ts, case when value > 100 then 'CRITICAL' else 'WARNING' end as severity,
         case when value > 100 then '#data-incidents' else '#data-quality-drift' end as channel,
         't' || user_id as table_name, event_id::varchar as message, coalesce(value > 100, false) as pages
  from events where event_type = 'error')"""


@query("alerts", f"with {_ALERTS_SQL} select * from alerts")
def alerts(spark: SparkSession, sf: str) -> DataFrame:
    return ntz(quality.alerts(_problems(spark, sf)))


@query("recent_alerts", f"with {_ALERTS_SQL} select ts, message from alerts order by ts desc, message desc limit 5")
def recent_alerts(spark: SparkSession, sf: str) -> DataFrame:
    return ntz(most_recent(quality.alerts(_problems(spark, sf)), ["ts", "message"]).select("ts", "message"))


@query("table_health", f"""
with {_ALERTS_SQL}
select 't' || user_id as table_name,
       case when max(case when a.table_name is not null then 1 else 0 end) = 1 then 'QUARANTINED' else 'HEALTHY' end as status
from events left join (
  select distinct table_name from alerts
  where pages and ts >= timestamp '2024-01-31' - interval 604800 second) a on a.table_name = 't' || user_id
group by 1""")
def table_health(spark: SparkSession, sf: str) -> DataFrame:
    tables = table(spark, sf, "events").select(F.concat(F.lit("t"), F.col("user_id")).alias("table_name"))
    now = F.lit("2024-01-31").cast("timestamp")
    return quality.table_health(quality.alerts(_problems(spark, sf)), tables, now, 7 * 86400)


@query("audit_duplicates", """
with e as (select count(*) as n from (select 1 from lineitem group by l_orderkey having count(*) > 2)),
     m as (select count(*) as n from (select 1 from orders group by o_orderkey having count(*) > 1))
select 'r1' as run_id, 'duplicate_check' as audit_name,
       case when e.n > 0 or m.n > 0 then 'failed' else 'passed' end as audit_status,
       '{"duplicate_embeddings":' || e.n || ',"duplicate_metadata":' || m.n || '}' as details from e, m""")
def audit_duplicates(spark: SparkSession, sf: str) -> DataFrame:
    many = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("screen_id"))
    one = table(spark, sf, "orders").select(F.col("o_orderkey").alias("screen_id"))
    return quality.audit_duplicates(many, one, run_id="r1")


@query("audit_whole_key", """
with e as (select count(*) as n from (
       select 1 from lineitem group by l_orderkey, l_linenumber, l_partkey, l_suppkey having count(*) > 1)),
     m as (select count(*) as n from (select 1 from orders group by o_orderkey having count(*) > 1))
select null::varchar as run_id, 'duplicate_check' as audit_name,
       case when e.n > 0 or m.n > 0 then 'failed' else 'passed' end as audit_status,
       '{"duplicate_embeddings":' || e.n || ',"duplicate_metadata":' || m.n || '}' as details from e, m""")
def audit_whole_key(spark: SparkSession, sf: str) -> DataFrame:
    """Embeddings audited by the whole four-part key."""
    keys = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
    one = table(spark, sf, "orders").select(F.col("o_orderkey").alias("screen_id"))
    return quality.audit_duplicates(table(spark, sf, "lineitem"), one, embedding_keys=keys)


# -- runs --------------------------------------------------------------------


def _runs(spark: SparkSession, sf: str) -> DataFrame:
    """Orders as started runs, ended by their last shipment."""
    started = table(spark, sf, "orders").select(
        F.col("o_orderkey").cast("string").alias("run_id"),
        shapes.ts("o_orderdate").alias("started_at"),
        F.lit(None).cast("timestamp").alias("ended_at"),
        F.lit("running").alias("status"),
    )
    ends = table(spark, sf, "lineitem").groupBy(F.col("l_orderkey").cast("string").alias("run_id")).agg(
        F.max(shapes.ts("l_shipdate")).alias("ended_at"), F.lit("succeeded").alias("status")
    )
    return runs.finish_runs(started, ends)


_RUNS_SQL = """
ended as (select l_orderkey, max(l_shipdate) as ended_at from lineitem group by 1),
runs as (
  select o_orderkey::varchar as run_id, o_orderdate as started_at, ended_at,
         case when l_orderkey is null then 'running' else 'succeeded' end as status
  from orders left join ended on o_orderkey = l_orderkey)"""


@query("start_run", """
select o_orderdate as started_at, 'running' as status, count(*) as orders from orders
where o_orderdate = (select max(o_orderdate) from orders) group by 1""")
def start_run(spark: SparkSession, sf: str) -> DataFrame:
    """A run that starts at the time of the newest order, stored and joined to that day's orders."""
    orders = table(spark, sf, "orders").select("o_orderdate")
    newest = orders.agg(F.max("o_orderdate").alias("t")).first()["t"]
    started = staged(runs.start_run(spark, newest), "runs").filter(F.length("run_id") == 36)
    joined = started.join(orders, F.col("started_at") == F.col("o_orderdate").cast("timestamp"))
    return ntz(joined.groupBy("started_at", "status").agg(F.count(F.lit(1)).alias("orders")))


@query("finish_runs", f"with {_RUNS_SQL} select * from runs")
def finish_runs(spark: SparkSession, sf: str) -> DataFrame:
    return ntz(_runs(spark, sf))


@query("run_metrics", f"""
with {_RUNS_SQL}, d as (
  select count(*)::double as n, count(distinct source)::double as apps, count(distinct lang)::double as cats,
         count(*) filter (where n_chars >= 500)::double as filled from documents)
select '10' as run_id, name as metric_name, v as metric_value from (
  select 'metadata_rows' as name, n as v from d
  union all select 'embedding_rows', count(*)::double from embeddings
  union all select 'distinct_app_packages', apps from d
  union all select 'distinct_categories', cats from d
  union all select 'extraction_payload_pct', 100.0::double * filled / n from d
  union all select 'review_queue_pct', 100.0::double * (select count(*) from labels where quality = 0) / n from d
  union all select 'run_duration_seconds', coalesce(max(epoch(ended_at) - epoch(started_at)), 0)::double
            from runs where run_id = '10')""")
def run_metrics(spark: SparkSession, sf: str) -> DataFrame:
    metadata = table(spark, sf, "documents").select(
        F.col("source").alias("app_package"),
        F.col("lang").alias("category"),
        F.when(F.col("n_chars") >= 500, F.col("doc_id")).alias("extraction_payload"),
    )
    review = table(spark, sf, "labels").filter("quality = 0")
    return runs.run_metrics(metadata, table(spark, sf, "embeddings"), review, _runs(spark, sf), "10")
