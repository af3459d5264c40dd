"""Merges, deduplication and change data capture on small tables."""

from __future__ import annotations

import json
import random

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tidewater.errors import ReconcileError
from tidewater.operators import cdc, dedup, merge
from tidewater.plans.cdc import apply_changes, current


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.fixture
def target(spark):
    return spark.createDataFrame([(1, "a"), (2, "b"), (2, "b2"), (None, "n")], "k int, v string")


@pytest.fixture
def source(spark):
    return spark.createDataFrame([(2, "B"), (3, "C"), (None, "N")], "k int, v string")


def test_upsert_updates_every_match_and_keeps_null_keys(target, source):
    want = [(1, "a"), (2, "B"), (2, "B"), (3, "C"), (None, "N"), (None, "n")]
    assert rows(merge.merge_upsert(target, source, ["k"])) == sorted(want, key=repr)


def test_upsert_with_null_value_overwrites(spark, target):
    source = spark.createDataFrame([(1, None)], "k int, v string")
    assert (1, None) in rows(merge.merge_upsert(target, source, ["k"]))


def test_upsert_equals_full_outer_join(spark):
    rng = random.Random(1)
    t = [(k, j, rng.random()) for k in range(40) for j in range(3) if rng.random() < 0.6]
    s = [(k, j, rng.random()) for k in range(60) for j in range(3) if rng.random() < 0.5]
    want = {(k, j): v for k, j, v in t} | {(k, j): v for k, j, v in s}
    schema = "k int, j int, v double"
    got = merge.merge_upsert(spark.createDataFrame(t, schema), spark.createDataFrame(s, schema), ["k", "j"])
    assert rows(got) == sorted(((k, j, v) for (k, j), v in want.items()), key=repr)


def test_upsert_refuses_repeated_source_key(spark, target):
    twice = spark.createDataFrame([(1, "x"), (1, "y")], "k int, v string")
    with pytest.raises(ValueError, match="repeats"):
        merge.merge_upsert(target, twice, ["k"])


def test_upsert_into_empty_target(spark, source):
    assert merge.merge_upsert(source.limit(0), source, ["k"]).count() == 3


def test_insert_if_absent_keeps_existing(spark, target, source):
    more = source.unionByName(spark.createDataFrame([(3, "A")], "k int, v string"))
    got = rows(merge.insert_if_absent(target, more, ["k"], ["v"]))
    assert got == sorted([(1, "a"), (2, "b"), (2, "b2"), (3, "A"), (None, "N"), (None, "n")], key=repr)


def test_update_by_key_changes_only_patched_columns(spark):
    t = spark.createDataFrame([(1, "a", "x"), (2, "b", "y")], "k int, v string, w string")
    p = spark.createDataFrame([(2, None), (9, "q")], "k int, v string")
    assert rows(merge.update_by_key(t, p, "k")) == [(1, "a", "x"), (2, None, "y")]


def test_delete_where_keeps_unknown(target):
    assert merge.delete_where(target, F.col("k") > 1).count() == 2


def test_insert_rows_fills_missing_with_null(target):
    assert (7, None) in rows(merge.insert_rows(target, [{"k": 7}]))


def test_classify(target, source):
    got = {(r["k"], r["merge_class"]) for r in merge.classify_merge(target, source, ["k"]).collect()}
    assert got == {(1, "target_only"), (2, "matched"), (3, "source_only"), (None, "target_only"), (None, "source_only")}


def test_dedup_is_repeatable_with_a_hot_key(spark):
    n = 30_000
    df = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id") % 500).alias("k"),
        F.hash("id").alias("o"), "id",
    )
    got = {(r["k"], r["id"]) for r in dedup.dedup(df, ["k"], ["o", "id"]).collect()}
    best = {}
    for r in df.collect():
        best[r["k"]] = min(best.get(r["k"], (r["o"], r["id"])), (r["o"], r["id"]))
    assert got == {(k, v[1]) for k, v in best.items()}


def test_dedup_plan_reduces_before_the_shuffle(spark):
    df = spark.range(10).select((F.col("id") % 2).alias("k"), "id")
    plan = dedup.dedup(df, ["k"], ["id"])._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan.split("Exchange")[1]


def test_dedup_null_keys_form_one_group(spark):
    df = spark.createDataFrame([(None, 2), (None, 1), (1, 1)], "k int, o int")
    assert rows(dedup.dedup(df, ["k"], ["o"])) == [(1, 1), (None, 1)]
    assert dedup.count_duplicates(df, ["k"]).first()[0] == 1
    assert tuple(dedup.dedup_report(df, ["k"]).first()) == (3, 2, 1)


def test_dedup_against_matches_nulls(spark):
    df = spark.createDataFrame([(None, 1), (2, 1), (3, 1)], "k int, j int")
    seen = spark.createDataFrame([(None, 1), (2, 1)], "k int, j int")
    assert rows(dedup.dedup_against(df, seen, ["k", "j"])) == [(3, 1)]


def test_empty_report(spark):
    assert tuple(dedup.dedup_report(spark.createDataFrame([], "k int"), ["k"]).first()) == (0, 0, 0)


# -- change data capture -----------------------------------------------------

FIELDS = {"id": "int", "name": "string"}
MIRROR = "id int, name string, last_updated_ms bigint"


def event(op, before=None, after=None, ts=1, lsn=1, wrap=True):
    body = {"op": op, "before": before, "after": after, "source": {"lsn": lsn, "table": "t"}, "ts_ms": ts}
    return json.dumps({"schema": {}, "payload": body} if wrap else body)


def log(spark, *values):
    data = [("t", 0, i, v) for i, v in enumerate(values)]
    return spark.createDataFrame(data, "topic string, partition int, offset bigint, value string")


def apply(spark, mirror, *values):
    start = spark.createDataFrame(mirror, MIRROR)
    return rows(apply_changes(start, cdc.parse_cdc(log(spark, *values), FIELDS), "id", ["name"]))


def test_both_envelope_shapes_and_tombstones(spark):
    records = log(spark, event("c", after={"id": 1, "name": "a"}), None, event("c", after={"id": 2}, wrap=False), "junk")
    got = cdc.parse_cdc(records, FIELDS)
    assert [(r["op"], r["after_id"], r["after_name"]) for r in got.orderBy("offset").collect()] == [
        ("c", 1, "a"), ("c", 2, None), (None, None, None)
    ]


def test_value_that_does_not_fit_is_null(spark):
    got = cdc.parse_cdc(log(spark, event("c", after={"id": "x", "name": "a"})), FIELDS).first()
    assert got["after_id"] is None and got["after_name"] == "a"


def test_nested_parse(spark):
    got = cdc.parse_cdc_nested(log(spark, event("u", {"id": 1}, {"id": 1, "name": "z"}, 7)), "struct<id:int,name:string>")
    r = got.first()
    assert (r["op"], r["before"]["id"], r["after"]["name"], r["ts_ms"], r["table"]) == ("u", 1, "z", 7, "t")


def test_schema_covers_all_records(spark):
    schema = cdc.infer_payload_schema(log(spark, event("d", {"id": 1}), event("c", after={"name": "a"})))
    assert "name" in schema and "id" in schema


def test_delete_update_insert(spark):
    got = apply(
        spark, [(1, "a", 1), (2, "b", 1), (3, "c", 1)],
        event("d", {"id": 1}, ts=2), event("u", {"id": 2}, {"id": 2, "name": "B"}, ts=3),
        event("r", after={"id": 4, "name": "D"}, ts=4), event("d", {"id": 9}, ts=5), event("x", after={"id": 3, "name": "?"}, ts=6),
    )
    assert got == [(2, "B", 3), (3, "c", 1), (4, "D", 4)]


def test_all_deletes_are_applied_not_one(spark):
    got = apply(spark, [(1, "a", 1), (2, "b", 1)], event("d", {"id": 1}, ts=2), event("d", {"id": 2}, ts=3))
    assert got == []


def test_tie_on_time_goes_to_later_log_position(spark):
    got = apply(
        spark, [], event("u", {"id": 1}, {"id": 1, "name": "new"}, 5, 20), event("c", None, {"id": 1, "name": "old"}, 5, 10)
    )
    assert got == [(1, "new", 5)]


def test_equal_ids_of_two_tables(spark):
    def of(table, name):
        return event("c", after={"id": 1, "name": name}).replace('"table": "t"', f'"table": "{table}"')

    events = cdc.with_entity_key(cdc.parse_cdc(log(spark, of("customers", "c"), of("drivers", "d")), FIELDS))
    assert cdc.latest_changes(events, ["source_table", "entity_id"]).count() == 2
    drivers = apply_changes(spark.createDataFrame([], MIRROR), cdc.for_table(events, "drivers"), "id", ["name"])
    assert rows(drivers) == [(1, "d", 1)]


def test_replay_is_dropped(spark):
    records = log(spark, event("c", after={"id": 1}), event("c", after={"id": 2}))
    assert cdc.new_events(records.limit(1), records).count() == 1
    assert cdc.new_events(records, records).count() == 0


def test_reconcile(spark):
    a = spark.createDataFrame([(1, "a"), (2, "b"), (3, None), (5, "e")], "id int, v string")
    b = spark.createDataFrame([(1, "a"), (2, "B"), (3, ""), (4, "d")], "id int, v string")
    assert rows(cdc.reconcile_rows(a, b, ["id"], ["v"])) == [(2, "changed"), (3, "changed"), (4, "extra"), (5, "missing")]
    cdc.assert_reconciled(a, b)
    with pytest.raises(ReconcileError):
        cdc.assert_reconciled(a, b.limit(1))


def test_merge_cdc_refuses_unreduced_events(spark):
    events = cdc.with_entity_key(cdc.parse_cdc(log(spark, *[event("c", after={"id": 1})] * 2), FIELDS))
    with pytest.raises(ValueError):
        merge.merge_cdc(spark.createDataFrame([], MIRROR), events, "id", {"name": "after_name"})


def test_merge_into_needs_a_table_that_supports_it(spark, source):
    source.createOrReplaceTempView("plain_target")
    with pytest.raises(PySparkException):
        merge.merge_into_table("plain_target", source, ["k"])


def test_replayed_and_late_events_change_nothing(spark):
    state = spark.createDataFrame([], MIRROR + ", last_lsn bigint, deleted boolean")
    new, old = event("u", {"id": 1}, {"id": 1, "name": "new"}, ts=200, lsn=9), event("c", None, {"id": 1, "name": "old"}, ts=100, lsn=3)
    gone, back = event("d", {"id": 2}, None, ts=150, lsn=5), event("c", None, {"id": 2, "name": "b"}, ts=120, lsn=4)
    for values in ((new, gone), (old, back), (new, gone)):
        state = apply_changes(state, cdc.parse_cdc(log(spark, *values), FIELDS), "id", ["name"])
    assert rows(current(state)) == [(1, "new", 200)]
    assert apply(spark, [(1, "new", 200)], old) == [(1, "new", 200)]


def test_other_columns_and_null_keys_of_a_mirror_stay(spark):
    mirror = spark.createDataFrame([(1, "a", 1, "x"), (None, "n", 1, "y"), (3, "c", 1, "z")], MIRROR + ", note string")
    events = cdc.parse_cdc(log(spark, event("u", {"id": 1}, {"id": 1, "name": "b"}, ts=2), event("c", None, {"id": 4, "name": "d"}, ts=2)), FIELDS)
    got = rows(apply_changes(mirror, events, "id", ["name"]))
    assert got == sorted([(1, "b", 2, "x"), (None, "n", 1, "y"), (3, "c", 1, "z"), (4, "d", 2, None)], key=repr)


def test_each_table_has_its_mirror(spark):
    events = cdc.parse_cdc(log(spark, event("c", None, {"id": 1, "name": "a"})), FIELDS)
    start = spark.createDataFrame([], MIRROR)
    assert apply_changes(start, events, "id", ["name"], "t").count() == 1
    assert apply_changes(start, events, "id", ["name"], "other").count() == 0


def test_a_merge_is_one_join_and_reads_each_side_once(spark, path):
    for name in ("t", "s"):
        spark.range(100).selectExpr("id as k", "id * 2 as v").write.parquet(path(name))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        merged = merge.merge_upsert(spark.read.parquet(path("t")), spark.read.parquet(path("s")), ["k"], check=False)
        plan = merged._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert (plan.count("SortMergeJoin"), plan.count("Exchange hash"), plan.count("FileScan")) == (1, 2, 2)


def test_bronze_is_compared_from_the_lowest_offset_on(spark):
    bronze = spark.createDataFrame([("a", 0, i) for i in range(10)] + [("b", 0, 99)], "topic string, partition int, offset bigint")
    batch = spark.createDataFrame([("a", 0, 9), ("a", 0, 10), ("b", 1, 0)], "topic string, partition int, offset bigint")
    assert rows(cdc.new_events(bronze, batch)) == [("a", 0, 10), ("b", 1, 0)]


def test_unreadable_records_are_returned(spark):
    events = cdc.parse_cdc(log(spark, "junk", event("c", None, {"id": 1})), FIELDS)
    assert cdc.unreadable(events).count() == 1
