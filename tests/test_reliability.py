"""Ledger, history, quality gates, alerts, audits and runs."""

from __future__ import annotations

from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidewater.errors import DataQualityError
from tidewater.operators import clean, history, quality, runs
from tidewater.plans.replicate import Replication, replica, replicate


def d(day):
    return date(2024, 5, day)


@pytest.fixture
def ledger(spark):
    at = datetime(2024, 6, 1)
    data = [("t", d(1), 10, at), ("t", d(5), 50, at), ("t", d(5), 51, at + timedelta(1)), ("t", d(9), 90, at), ("u", d(4), 7, at)]
    return spark.createDataFrame(data, history.LEDGER_SCHEMA)


@pytest.mark.parametrize(
    ("table", "day", "want"), [("t", 1, None), ("t", 2, 10), ("t", 5, 10), ("t", 6, 51), ("t", 20, 90), ("u", 5, 7), ("x", 5, None)]
)
def test_lookup_is_strictly_before_and_last_recorded_wins(spark, ledger, table, day, want):
    assert history.get_snapshot_before(ledger, table, d(day)) == want
    asked = spark.createDataFrame([(table, d(day))], "table_name string, execution_date date")
    assert history.snapshot_before(ledger, asked).first()["snapshot_id"] == want


def test_lookup_keeps_every_request(spark, ledger):
    asked = spark.createDataFrame([("t", d(6), 1), ("t", d(6), 2), ("t", d(1), 3)], "table_name string, execution_date date, n int")
    got = {(r["n"], r["snapshot_id"], r["prev_date"]) for r in history.snapshot_before(ledger, asked).collect()}
    assert got == {(1, 51, d(5)), (2, 51, d(5)), (3, None, None)}


def test_ledger_file(spark, path):
    where = path("ledger")
    assert history.read_ledger(spark, where).count() == 0
    history.record_snapshot(spark, where, "t", d(1), 5)
    history.record_snapshot(spark, where, "t", d(1), 6)
    assert history.get_snapshot_before(history.read_ledger(spark, where), "t", d(2)) == 6
    assert history.ledger_stats(history.read_ledger(spark, where)).first()["merges"] == 2


def users(spark, ids):
    return spark.createDataFrame([(i, f"u{i}") for i in ids], "user_id int, email string")


def merged(spark, path, ids, day):
    return history.stateful_merge(
        spark, path("h"), users(spark, ids), ["user_id"], "users", d(day), path("l")
    )


def test_backfill_starts_before_its_date(spark, path):
    merged(spark, path, range(10), 1)
    merged(spark, path, range(20), 9)
    made = merged(spark, path, range(5, 12), 5)
    assert history.state_at(spark, path("h"), made).count() == 12
    assert history.current_snapshot_id(spark, path("h")) == made


def test_failed_merge_records_nothing(spark, path):
    first = merged(spark, path, [1, 2], 1)
    with pytest.raises(ValueError):
        merged(spark, path, [3, 3], 2)
    assert history.current_snapshot_id(spark, path("h")) == first
    assert history.read_ledger(spark, path("l")).count() == 1
    assert history.snapshots(spark, path("h")).count() == 1


@pytest.mark.parametrize("fails", [False, True])
def test_table_merge_order_and_no_record_on_failure(spark, path, monkeypatch, fails):
    """Lookup, rollback, merge, record, in that order, and no record if the merge fails."""
    calls = []
    history.record_snapshot(spark, path("l"), "cat.s.t", d(1), 11)
    monkeypatch.setattr(history, "rollback_table", lambda _, table, snap: calls.append(("rollback", table, snap)))

    def merge(table, source, keys):
        calls.append(("merge", table, keys))
        if fails:
            raise RuntimeError("lost")

    monkeypatch.setattr(history, "merge_into_table", merge)
    monkeypatch.setattr(type(spark.catalog), "tableExists", lambda *_: True)
    made = spark.createDataFrame([(11, datetime(2024, 1, 1)), (12, datetime(2024, 1, 2))], "snapshot_id bigint, committed_at timestamp")
    monkeypatch.setattr(history, "table_snapshots", lambda *_: made)
    run = lambda: history.stateful_merge_table(spark, "cat.s.t", users(spark, [1]), ["user_id"], d(2), path("l"))
    if fails:
        with pytest.raises(RuntimeError):
            run()
    else:
        assert run() == 12
    assert calls == [("rollback", "cat.s.t", 11), ("merge", "cat.s.t", ["user_id"])]
    assert history.read_ledger(spark, path("l")).count() == (1 if fails else 2)


def test_rollback(spark, path):
    root = path("h")
    assert history.current_snapshot_id(spark, root) is None
    a = history.commit_state(spark, root, users(spark, [1]))
    b = history.commit_state(spark, root, users(spark, [1, 2]))
    history.rollback(spark, root, a)
    assert history.current_snapshot_id(spark, root) == a
    assert history.commit_state(spark, root, users(spark, [3])) == b + 1
    assert history.state_at(spark, root, b).count() == 2


def test_state_from_changes(spark):
    log = spark.createDataFrame([(1, "a", 1), (1, "b", 2), (1, "c", 3), (2, "x", 2)], "k int, v string, snapshot_id bigint")
    got = {(r["k"], r["v"]) for r in history.state_from_changes(log, ["k"], 2).collect()}
    assert got == {(1, "b"), (2, "x")}


def test_change_log_follows_the_line_of_a_snapshot(spark, path):
    """After a backfill the snapshots of both lines can be read, also by later merges."""
    root, keys = path("h"), ["user_id"]

    def merge(rows, day):
        source = spark.createDataFrame(rows, "user_id int, email string")
        return history.stateful_merge_changes(spark, root, source, keys, "users", d(day), path("l"))

    def state(snap):
        return sorted((tuple(r) for r in history.state_at_changes(spark, root, keys, snap).collect()), key=repr)

    first = merge([(1, "a"), (2, "b"), (None, "n")], 1)
    ninth = merge([(2, "B"), (3, "c"), (None, "n")], 9)
    fifth = merge([(1, "A")], 5)
    tenth = merge([(4, "d")], 10)
    assert state(first) == [(1, "a"), (2, "b"), (None, "n")]
    assert state(fifth) == [(1, "A"), (2, "b"), (None, "n")]
    assert state(ninth) == [(1, "a"), (2, "B"), (3, "c"), (None, "n"), (None, "n")]
    assert state(tenth) == [(1, "a"), (2, "B"), (3, "c"), (4, "d"), (None, "n"), (None, "n")]
    assert history.lineage(spark, root, tenth) == [tenth, ninth, first]
    with pytest.raises(ValueError):
        merge([(5, "x"), (5, "y")], 11)
    assert history.current_snapshot_id(spark, root) == tenth


# -- quality -----------------------------------------------------------------

CFG = quality.TableChecks("t", "id", ["a", "b"])


def audit(df, cfg=CFG):
    return {r["check"]: (r["status"], r["value"], r["detail"]) for r in quality.pre_audit(df, cfg).collect()}


def table(spark, n, nulls_a=0, nulls_b=0, dups=0):
    return spark.range(n).select(
        F.when(F.col("id") < dups * 2, F.col("id") % dups if dups else F.col("id")).otherwise(F.col("id")).alias("id"),
        F.when(F.col("id") >= nulls_a, 1).alias("a"),
        F.when(F.col("id") >= nulls_b, 1).alias("b"),
    )


def test_empty_table(spark):
    got = audit(table(spark, 0))
    assert got["freshness"][0] == "CRITICAL" and got["volume"][0] == "CRITICAL"
    assert got["completeness"] == ("OK", 0.0, "a") and got["consistency"][0] == "OK"


def test_null_rate_at_the_limit_passes_and_worst_column_is_named(spark):
    assert audit(table(spark, 1000, 10, 0))["completeness"] == ("OK", 0.01, "a")
    assert audit(table(spark, 1000, 11, 20))["completeness"] == ("WARNING", 0.02, "b")


def test_repeated_and_null_keys(spark):
    assert audit(table(spark, 100, dups=3))["consistency"] == ("CRITICAL", 3.0, "id")
    nulls = spark.createDataFrame([(None, 1, 1), (None, 1, 1)], "id int, a int, b int")
    assert audit(nulls)["consistency"][:2] == ("CRITICAL", 1.0)


def test_pre_audit_tolerates_a_missing_table_and_no_critical_columns(spark):
    assert quality.pre_audit(None, CFG).count() == 0
    assert audit(table(spark, 5), quality.TableChecks("t", "id"))["completeness"][0] == "OK"


def test_gate_leaves_an_alert_then_raises(spark, path):
    quality.post_audit(table(spark, 10), CFG, path("alerts"))
    with pytest.raises(DataQualityError, match="2 values"):
        quality.post_audit(table(spark, 10, dups=2), CFG, path("alerts"))
    row = spark.read.parquet(path("alerts")).first()
    assert (row["severity"], row["channel"], row["pages"]) == ("CRITICAL", "#data-incidents", True)


def test_alert_routing(spark):
    data = [(datetime(2024, 1, 1), s, "t", "m") for s in ("CRITICAL", "WARNING")]
    got = quality.alerts(spark.createDataFrame(data, "ts timestamp, severity string, table_name string, message string"))
    assert {(r["severity"], r["channel"], r["pages"]) for r in got.collect()} == {
        ("CRITICAL", "#data-incidents", True), ("WARNING", "#data-quality-drift", False)
    }
    assert quality.severity_of(DataQualityError()) == "CRITICAL" and quality.severity_of(OSError()) == "WARNING"


def test_health_window(spark):
    at = datetime(2024, 1, 1, 12, 0, 0)
    data = [(at - timedelta(seconds=s), sev, t, "m") for s, sev, t in ((60, "CRITICAL", "a"), (61, "CRITICAL", "b"), (1, "WARNING", "c"))]
    rows = quality.alerts(spark.createDataFrame(data, "ts timestamp, severity string, table_name string, message string"))
    tables = spark.createDataFrame([("a",), ("b",), ("c",), ("d",)], "table_name string")
    got = dict(tuple(r) for r in quality.table_health(rows, tables, F.lit(at)).collect())
    assert got == {"a": "QUARANTINED", "b": "HEALTHY", "c": "HEALTHY", "d": "HEALTHY"}


def test_sla(spark):
    df = spark.createDataFrame([(datetime(2024, 1, 1, 0),)], "ts timestamp")
    for hour, want in ((6, "OK"), (7, "CRITICAL")):
        assert quality.check_sla(df, "t", "ts", 6, F.lit(datetime(2024, 1, 1, hour))).first()["status"] == want
    assert quality.check_sla(df.limit(0), "t", "ts", 6, F.lit(datetime(2024, 1, 1))).first()["status"] == "CRITICAL"


def test_audit_is_stored_before_it_stops_the_run(spark, path):
    emb = spark.createDataFrame([(1,), (1,), (1,), (2,), (2,)], "screen_id int")
    meta = spark.createDataFrame([(1,), (2,)], "screen_id int")
    quality.enforce_audit(quality.audit_duplicates(emb.limit(2), meta, run_id="r"), path("audits"))
    with pytest.raises(DataQualityError):
        quality.enforce_audit(quality.audit_duplicates(emb, meta, run_id="r"), path("audits"))
    got = spark.read.parquet(path("audits")).select("audit_status", "details").collect()
    assert {r["audit_status"] for r in got} == {"passed", "failed"}


def test_tasks_of_an_audit_do_not_grow_with_the_keys(spark):
    keys = spark.range(600_000).select(F.xxhash64("id").alias("screen_id"), (F.col("id") % 7).alias("line"))
    few = spark.range(0, 5, 1, 1).select(F.col("id").alias("screen_id"))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    spark.sparkContext.setJobGroup("audit", "audit")
    try:
        row = quality.audit_duplicates(keys, few, embedding_keys=["screen_id", "line"]).first()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert row["audit_status"] == "passed"
    tracker = spark.sparkContext.statusTracker()
    stages = [tracker.getStageInfo(i) for job in tracker.getJobIdsForGroup("audit") for i in tracker.getJobInfo(job).stageIds]
    # One is the scan, the other counts the keys; with one partition of each input that would be two tasks.
    assert sum(1 for stage in stages if stage and stage.numCompletedTasks > 2) >= 2
    assert spark.conf.get("spark.sql.adaptive.coalescePartitions.initialPartitionNum", None) is None


# -- runs and replication ----------------------------------------------------


def test_run_registry(spark):
    start = datetime(2024, 1, 1)
    run = runs.start_run(spark, start, limit_param=5, prompt_version="v1")
    run_id = run.first()["run_id"]
    assert runs.run_duration(run, run_id).first()[0] == 0.0
    done = runs.finish_run(run, run_id, F.lit(start + timedelta(seconds=90)))
    assert done.first()["status"] == "succeeded" and runs.run_duration(done, run_id).first()[0] == 90.0
    meta = spark.createDataFrame([("a", "x", "{}"), ("a", "y", None)], "app_package string, category string, extraction_payload string")
    got = {r["metric_name"]: r["metric_value"] for r in runs.run_metrics(meta, meta, meta.limit(1), done, run_id).collect()}
    assert got == {
        "metadata_rows": 2.0, "embedding_rows": 2.0, "distinct_app_packages": 1.0, "distinct_categories": 2.0,
        "extraction_payload_pct": 50.0, "review_queue_pct": 50.0, "run_duration_seconds": 90.0,
    }
    empty = runs.run_metrics(meta.limit(0), meta.limit(0), meta.limit(0), done, "none")
    assert {r["metric_value"] for r in empty.collect()} == {0.0}


def csv(spark, path, name, ids, twice=()):
    users(spark, [*ids, *twice]).coalesce(1).write.option("header", True).mode("overwrite").csv(path(name))
    return path(name)


def test_replication_end_to_end(spark, path):
    """A truncated source after a rollback keeps all rows; repeated keys fail the run."""

    def cfg(source):
        return Replication("users", "user_id", source, path("h"), path("l"), ["email"], path("a"), "user_id int, email string")

    before, first = replicate(spark, cfg(csv(spark, path, "full", range(1000))), d(1))
    assert before.count() == 0
    before, second = replicate(spark, cfg(csv(spark, path, "part", range(700))), d(2))
    assert {r["status"] for r in before.collect()} == {"OK"}
    assert history.state_at(spark, path("h"), second).count() == 1000
    with pytest.raises(ValueError, match="repeats"):
        replicate(spark, cfg(csv(spark, path, "dups", range(700), range(1, 11))), d(3))
    assert history.current_snapshot_id(spark, path("h")) == second


def test_repeated_ends_of_a_run(spark):
    run = runs.start_run(spark, datetime(2024, 1, 1))
    run_id = run.first()["run_id"]
    ends = spark.createDataFrame(
        [(run_id, datetime(2024, 1, 1, 1), "failed"), (run_id, datetime(2024, 1, 1, 2), "succeeded")] * 2,
        "run_id string, ended_at timestamp, status string",
    )
    got = runs.finish_runs(run, ends).collect()
    assert [(r["status"], r["ended_at"]) for r in got] == [("succeeded", datetime(2024, 1, 1, 2))]


def test_ids_of_keys_with_nulls_differ(spark):
    df = spark.createDataFrame([(None, 1), (1, None), (None, 1)], "a int, b int")
    assert clean.with_row_id(df, "a", "b").select("trip_id").distinct().count() == 2


def test_replication_by_batches_writes_the_batches_only(spark, path):
    def cfg(source):
        return Replication("users", "user_id", source, path("h"), path("l"), ["email"], path("a"), "user_id int, email string", "batches")

    for day, ids in ((1, range(1000)), (9, range(990, 1010)), (5, range(5))):
        _, made = replicate(spark, cfg(csv(spark, path, f"day{day}", ids)), d(day))
    # The backfill starts from what the table was before its date.
    assert replica(spark, cfg(""), made).count() == 1000
    assert spark.read.parquet(path("h") + "/changes").count() == 1000 + 20 + 5
