"""Streams that lose nothing: corrected gold, state that expires, recorded progress; and mergeable sketches."""

from __future__ import annotations

from datetime import datetime, timedelta

import pytest
from oracle import compare, connect
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from tidewater import streaming
from tidewater.operators import sketches
from tidewater.sources import read_table_stream
from tidewater.workloads import QUERIES, SQL

START = datetime(2024, 1, 1)


def at(hours):
    return START + timedelta(hours=hours)


# -- gold --------------------------------------------------------------------

TRIPS = "k long, pickup_zone string, pickup_ts timestamp, fare_amount long"


def feed(spark, path, rows, schema):
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(path)
    return read_table_stream(spark, path=path, schema=spark.createDataFrame([], schema).schema, files_per_batch=1)


def test_late_rows_of_any_age_correct_gold(spark, path):
    places = path("silver"), path("gold"), path("ckpt")

    def run(rows):
        stream = feed(spark, path("in"), rows, TRIPS)
        streaming.corrected_gold(stream, *places, ["k", "pickup_ts"]).awaitTermination()
        gold = spark.read.parquet(path("gold")).collect()
        return {(r["pickup_zone"], r["pickup_hour"]): (r["trip_count"], r["avg_fare"]) for r in gold}

    assert run([(1, "a", at(0.1), 10), (2, "a", at(0.2), 20), (2, "a", at(0.2), 20)]) == {("a", at(0)): (2, 15.0)}
    later = run([(3, "a", at(500), 5), (4, None, at(500), 7), (9, "x", None, 1)])
    assert later == {("a", at(0)): (2, 15.0), ("a", at(500)): (1, 5.0), (None, at(500)): (1, 7.0)}
    late = run([(5, "a", at(0.9), 60), (1, "a", at(0.1), 10)])
    assert late == later | {("a", at(0)): (3, 30.0)}
    assert spark.read.parquet(path("silver")).count() == 6


def test_a_batch_that_is_run_again_leaves_gold_as_it_was(spark, path):
    stream = feed(spark, path("in"), [(1, "a", at(0.1), 10), (2, "b", at(30), 20)], TRIPS)
    for checkpoint in ("one", "two"):
        streaming.corrected_gold(stream, path("silver"), path("gold"), path(checkpoint), ["k", "pickup_ts"]).awaitTermination()
        assert spark.read.parquet(path("gold")).agg(F.sum("trip_count")).first()[0] == 2
    with pytest.raises(ValueError, match="has to be one of the keys"):
        streaming.corrected_gold(stream, path("s"), path("g"), path("c"), ["k"])


def test_only_the_days_of_a_batch_are_written_anew(spark, path):
    stream = feed(spark, path("in"), [(1, "a", at(0.1), 10), (2, "a", at(30), 20)], TRIPS)
    streaming.corrected_gold(stream, path("silver"), path("gold"), path("ckpt"), ["k", "pickup_ts"]).awaitTermination()
    before = {p: p.stat().st_mtime_ns for p in __import__("pathlib").Path(path("gold")).rglob("part-*")}
    stream = feed(spark, path("in"), [(3, "a", at(31), 40)], TRIPS)
    streaming.corrected_gold(stream, path("silver"), path("gold"), path("ckpt"), ["k", "pickup_ts"]).awaitTermination()
    after = {p: p.stat().st_mtime_ns for p in __import__("pathlib").Path(path("gold")).rglob("part-*")}
    same = {p.parent.name for p in before if after.get(p) == before[p]}
    assert same == {"gold_day=2024-01-01"} and len(after) == 2


# -- state that expires ------------------------------------------------------

EVENTS = "k long, ts timestamp, arrived timestamp, _n int"


def test_first_within_a_time_keeps_late_rows_and_forgets(spark, path):
    def run(rows):
        stream = feed(spark, path("in"), rows, EVENTS)
        first = streaming.first_within(stream, ["k"], "ts", "arrived", "2 hours", 3600)
        streaming.run_once(first, path("out"), path("ckpt"))
        got = spark.read.parquet(path("out")).collect()
        return {(r["k"], r["arrived"]): r["late"] for r in got}, streaming.state_rows(spark, path("ckpt"), variable="passed").count()

    # A new key that is late, one that is not, a hot key with copies within and beyond the hour, and a NULL key.
    hot = [(7, at(0), at(0) + timedelta(minutes=m), m) for m in range(90)]
    got, _ = run([(1, at(0), at(3), 0), (2, at(3), at(3), 0), (None, at(0), at(0), 0), *hot])
    first = {(1, at(3)): True, (2, at(3)): False, (None, at(0)): False, (7, at(0)): False, (7, at(0) + timedelta(minutes=61)): False}
    assert got == first
    # A copy within the hour is dropped, also in a later batch; one beyond it is passed on and late.
    got, _ = run([(1, at(0), at(3.5), 1), (2, at(3), at(4.5), 1), (3, None, at(4.5), 0)])
    assert got == first | {(2, at(4.5)): False, (3, at(4.5)): False}
    # All keys but the last one's are forgotten once the log has gone on.
    _, held = run([(8, at(50), at(50), 0)])
    _, held = run([(9, at(60), at(60), 0)])
    assert held <= 2 * 2


def test_rows_without_an_arrival_are_refused(spark, path):
    stream = feed(spark, path("in"), [(1, at(0), None, 0)], EVENTS)
    first = streaming.first_within(stream, ["k"], "ts", "arrived", "2 hours", 3600)
    with pytest.raises(StreamingQueryException):
        streaming.run_once(first, path("out"), path("ckpt"))


def test_first_within_runs_in_a_session_with_another_state_store(spark, sf):
    name = "spark.sql.streaming.stateStore.providerClass"
    before, other = spark.conf.get(name), "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider"
    spark.conf.set(name, other)
    try:
        assert compare(spark, connect(sf), QUERIES["first_within"], SQL["first_within"], sf) is None
        assert spark.conf.get(name) == other
    finally:
        spark.conf.set(name, before)


def test_first_within_tells_keys_of_one_bucket_apart(spark, path):
    micro = timedelta(microseconds=1)
    keys = [(at(0), "1", 0.0), (at(0) + micro, "1", 0.0), (at(0), None, 0.0), (None, "1", 0.0), (at(0), "1", float("nan"))]
    rows = [(*k, at(0), at(0) + timedelta(minutes=m)) for k in keys for m in (0, 30, 70)]
    rows += [(at(0), "1", -0.0, at(0), at(0.25))]
    stream = feed(spark, path("in"), rows, "t timestamp, s string, d double, ts timestamp, arrived timestamp")
    first = streaming.first_within(stream, ["t", "s", "d"], "ts", "arrived", "2 hours", 3600, buckets=1)
    with streaming.rocksdb_state(spark):
        streaming.run_once(first, path("out"), path("ckpt"))
    got = spark.read.parquet(path("out")).groupBy("t", "s", "d").agg(F.collect_set("arrived").alias("at")).collect()
    assert len(got) == len(keys) and all(sorted(r["at"]) == [at(0), at(0) + timedelta(minutes=70)] for r in got)


# -- progress ----------------------------------------------------------------


def test_progress_is_recorded(spark, path):
    rows = [(i, "z", at(0), i) for i in range(30)]
    assert streaming.read_progress(spark, path("progress")).count() == 0
    with streaming.recorded(spark, path("progress")) as listener:
        for n in range(2):
            stream = feed(spark, path("in"), rows[n * 10 : n * 10 + 10], TRIPS)
            streaming.stream_append(stream, path("out"), path("ckpt"), name="p").awaitTermination()
    got = streaming.read_progress(spark, path("progress")).filter("input_rows > 0").collect()
    assert [(r["name"], r["input_rows"]) for r in sorted(got, key=lambda r: r["batch_id"])] == [("p", 10), ("p", 10)]
    assert len({r["run_id"] for r in got}) == 2 and len({r["query_id"] for r in got}) == 1 and listener.rows == []
    # Nothing is recorded outside the block.
    streaming.stream_append(feed(spark, path("in"), rows[20:], TRIPS), path("out"), path("ckpt")).awaitTermination()
    assert streaming.read_progress(spark, path("progress")).agg(F.sum("input_rows")).first()[0] == 20


# -- sketches ----------------------------------------------------------------


def test_merged_sketches_are_those_of_the_union(spark):
    df = spark.range(40_000).select(
        (F.col("id") % 4).alias("day"), F.when(F.col("id") % 10 != 0, F.col("id") % 7000).alias("u"), (F.col("id") % 1000).alias("v")
    )
    days = sketches.sketched(df, ["day"], ["u"], ["v"])
    whole = sketches.estimates(sketches.merged(days, []), (0.1, 0.5, 0.99)).first()
    exact = df.select("u").distinct().count() - 1
    assert whole["n"] == 40_000 and abs(whole["distinct_u"] - exact) <= 0.05 * exact
    for q in (10, 50, 99):
        assert abs(whole[f"v_p{q}"] / 1000 - q / 100) <= 0.04
    two = sketches.merged(days.filter("day < 2").withColumn("part", F.lit("x")), ["part"])
    assert sketches.estimates(two).first()["n"] == 20_000
    none = sketches.estimates(sketches.merged(sketches.sketched(df.filter("id < 0"), ["day"], ["u"]), ["day"]))
    assert none.collect() == []


def test_a_bronze_file_can_be_read_by_several_tasks(spark, sf, monkeypatch):
    import glob

    import pyarrow.parquet as pq

    from tidewater.session import application_dir
    from tidewater.workloads import streams

    monkeypatch.setattr(streams, "ROW_GROUP", 8 << 10)
    files = lambda: set(glob.glob(f"{application_dir(spark)}/stream-*/bronze/part-*.parquet"))
    before = files()
    assert streams.silver_stream(spark, sf).count() == spark.read.parquet(f"{sf}/events.parquet").count()
    written = files() - before
    assert len(written) == 8 and all(pq.ParquetFile(f).metadata.num_row_groups > 1 for f in written)
