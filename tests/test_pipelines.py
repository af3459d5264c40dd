"""Sources, sinks, cleaning, streams and the trip pipelines on small tables."""

from __future__ import annotations

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidewater import shared_dir, sinks, sources, streaming
from tidewater.functions import channel, json_set, json_text, l2_normalize, ratio
from tidewater.operators import clean, enrich, gold
from tidewater.plans import trips

TRIP = (
    "VendorID int, pickup_ts string, dropoff_ts string, passenger_count int, trip_distance double, "
    "PULocationID int, DOLocationID int, fare_amount double"
)
KEYS = ["VendorID", "pickup_ts", "dropoff_ts", "PULocationID", "DOLocationID"]


def trip(i=1, start="2024-01-01 10:00:00", end="2024-01-01 10:30:30", people=1, miles=1.0, pu=1, do=2, fare=5.0):
    return (i, start, end, people, miles, pu, do, fare)


@pytest.fixture
def zones(spark):
    return spark.createDataFrame(
        [(1, "Z1", "B1", "S"), (2, "Z2", "B2", "S")], "LocationID int, Zone string, Borough string, service_zone string"
    )


def test_basic_rules_drop_nulls_and_bad_times(spark):
    raw = spark.createDataFrame(
        [trip(), trip(people=None), trip(people=0, miles=0.0), trip(people=-1), trip(miles=-1.0), trip(miles=None),
         trip(start="nope"), trip(end=None)], TRIP)
    assert clean.clean_basic(clean.typed_trips(raw)).count() == 2


def test_strict_rules(spark):
    raw = spark.createDataFrame(
        [trip(), trip(people=6), trip(people=7), trip(people=0), trip(miles=0.0), trip(fare=0.0),
         trip(end="2024-01-01 10:00:00")], TRIP)
    assert clean.clean_strict(clean.typed_trips(raw)).count() == 2


def test_reject_samples(spark):
    raw = spark.createDataFrame([trip(miles=-1.0)] * 9 + [trip()], TRIP)
    rules = {"far": F.col("trip_distance") > 0, "near": F.col("trip_distance") < 0}
    got = clean.reject_samples(raw, rules, 5).groupBy("rule").count().collect()
    assert {(r["rule"], r["count"]) for r in got} == {("far", 1), ("near", 5)}


def test_duration_and_months(spark):
    raw = clean.typed_trips(spark.createDataFrame([trip(), trip(start="2023-10-01 00:00:00"), trip(start="2023-09-30 23:59:59")], TRIP))
    got = clean.with_duration(raw).first()["trip_duration_minutes"]
    assert got == 30.5
    assert clean.last_n_months(raw, "pickup_ts", 3).count() == 2
    assert clean.last_n_months(raw, "pickup_ts", None).count() == 3


def test_zone_lookup_keeps_unmatched(spark, zones):
    raw = spark.createDataFrame([trip(), trip(pu=None, do=9)], TRIP)
    got = enrich.enrich_zones(raw, zones)
    assert {(r["pickup_zone"], r["dropoff_borough"]) for r in got.collect()} == {("Z1", "B2"), (None, None)}


def test_hot_zone_survives_without_broadcast(spark, zones):
    """A shuffle join of the lookup gives the same as the broadcast."""
    raw = spark.range(3000).select(F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id")).cast("int").alias("PULocationID"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = enrich.enrich_zones(raw, zones, dropoff=None).groupBy("pickup_zone").count().collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert {r["pickup_zone"]: r["count"] for r in got} == {"Z1": 1001, "Z2": 1, None: 1998}


def test_gold_null_time(spark):
    df = spark.createDataFrame([("a", None, 1.0, 2.0), ("a", datetime(2024, 1, 1, 5, 59), 3.0, 4.0)],
                               "z string, ts timestamp, f double, d double")
    assert gold.gold_zone_hour_window(df, "z", "ts", "f").count() == 1
    assert gold.gold_zone_period(df, "z", "ts", "f", "d").count() == 2


def test_rates_of_empty_tables(spark):
    none = spark.createDataFrame([], "a int")
    assert gold.null_rates(none, ["a"]).first()[0] == 0.0
    assert gold.pct_where(none, F.col("a") > 0).first()[0] is None
    assert gold.pct_of(none, none).first()[0] is None
    assert tuple(gold.layer_counts(x=none, y=none).first()) == (0, 0)


def test_scalars(spark):
    one = spark.range(1)
    assert one.select(ratio(F.lit(1), F.lit(0))).first()[0] is None
    assert one.select(channel(F.lit("odd"))).first()[0] == "#data-incidents"
    assert one.select(json_text(F.lit('{"a": "", "b": "x"}'), "a", "b", default="")).first()[0] == "x"
    assert one.select(json_text(F.lit(None).cast("string"), "a", default="")).first()[0] == ""
    kept = one.select(json_set(F.lit('{"a": [1, {"b": null}], "k": 1}'), "k", F.to_variant_object(F.struct(F.lit(2).alias("n"))))).first()[0]
    assert kept.replace(" ", "") == '{"a":[1,{"b":null}],"k":{"n":2}}'
    assert one.select(l2_normalize(F.array(F.lit(0.0), F.lit(0.0)))).first()[0] == [0.0, 0.0]
    assert one.select(l2_normalize(F.array(F.lit(3.0), F.lit(4.0)))).first()[0] == pytest.approx([0.6, 0.8])


# -- sources and sinks -------------------------------------------------------


def test_objects_and_texts(spark, tmp_path):
    (tmp_path / "a.png").write_bytes(b"\x89PNG\x00")
    (tmp_path / "a.json").write_text('{"a":\n1}')
    assert bytes(sources.read_objects(spark, f"{tmp_path}/*.png").first()["content"]) == b"\x89PNG\x00"
    assert sources.read_texts(spark, f"{tmp_path}/*.json").first()["text"] == '{"a":\n1}'
    listed = sources.list_files(spark, f"{tmp_path}/*.png").first()
    assert (listed["file_name"], listed["length"]) == ("a.png", 5)


def test_external_systems_need_their_connectors(spark):
    for read in (
        lambda: sources.read_event_log(spark, "host:1", ["a", "b"]),
        lambda: sources.read_event_stream(spark, "host:1", "a.*"),
        lambda: sources.read_jdbc(spark, "jdbc:none:x", "t", "id", (0, 9), 3),
    ):
        with pytest.raises(Exception, match="(?i)kafka|driver"):
            read()


def test_inferred_csv_types(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id,v\n1,x\n")
    (tmp_path / "b.csv").write_text("id,v\n2,\n")
    df = sources.read_csv_dir(spark, str(tmp_path))
    assert df.dtypes == [("id", "int"), ("v", "string")] and df.count() == 2


def test_empty_batch_adds_nothing_and_the_plan_runs_once(spark, path):
    assert not sinks.append_nonempty(spark.range(0), path("x"))
    assert spark.read.parquet(path("x")).count() == 0
    seen = spark.sparkContext.accumulator(0)

    def count(parts):
        for part in parts:
            seen.add(len(part))
            yield part

    assert sinks.append_nonempty(spark.range(5).mapInArrow(count, "id long"), path("x"))
    assert seen.value == 5 and spark.read.parquet(path("x")).count() == 5


def test_partition_overwrite_leaves_other_partitions(spark, path):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "v int, p string")
    sinks.overwrite_partitions(df, path("x"), "p")
    sinks.overwrite_partitions(df.filter("p = 'b'").withColumn("v", F.lit(9)), path("x"), "p")
    assert {tuple(r) for r in spark.read.parquet(path("x")).select("v", "p").collect()} == {(1, "a"), (9, "b")}


def test_tables(spark, path):
    sinks.overwrite_table(spark.range(3), "tw_over", path("t"))
    sinks.overwrite_table(spark.range(2), "tw_over", path("t"))
    sinks.create_or_append(spark.range(2), "tw_over")
    assert sources.read_table(spark, "tw_over").count() == 4
    land(spark, path, "in", [(1, at(0))])
    streaming.stream_to_table(stream(spark, path, "in"), "tw_streamed", path("c")).awaitTermination()
    assert sources.read_table(spark, "tw_streamed").count() == 1
    for name in ("tw_over", "tw_streamed"):
        spark.sql(f"drop table {name}")


def test_append_by_name(spark, path):
    sinks.create_or_append(spark.createDataFrame([(1, "x")], "a int, b string"), "tw_named_columns", path("t"))
    sinks.create_or_append(spark.createDataFrame([("y", 2)], "b string, a int"), "tw_named_columns")
    assert {(r["a"], r["b"]) for r in spark.table("tw_named_columns").collect()} == {(1, "x"), (2, "y")}
    with pytest.raises(ValueError, match="columns"):
        sinks.create_or_append(spark.createDataFrame([(1,)], "a int"), "tw_named_columns")
    spark.sql("drop table tw_named_columns")


def test_shared_dir_comes_from_the_session(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir").rstrip("/")


def test_staged_data_lies_in_one_folder_per_application(spark):
    import os

    from tidewater import drop_staged, fresh_path, staged

    assert staged(spark.range(3)).count() == 3
    folder = os.path.dirname(fresh_path(spark, "x"))
    assert os.path.basename(folder) == spark.sparkContext.applicationId and os.listdir(folder)
    drop_staged(spark)
    assert not os.path.exists(folder)


def test_inbox(spark, path, zones):
    inbox, manifest, out = path("inbox"), path("manifest"), path("out")

    def arrive(*rows):
        spark.createDataFrame(rows, TRIP).coalesce(1).write.mode("append").parquet(inbox)

    def run():
        return trips.ingest_inbox(spark, f"{inbox}/*.parquet", manifest, out, zones, KEYS, ["fare_amount"], months=1)

    arrive(trip(), trip(), trip(start="2023-11-30 00:00:00"), trip(miles=-1.0))
    assert run() == 1
    first = spark.read.parquet(out)
    assert first.count() == 1 and first.first()["trip_duration_minutes"] == 30.5
    assert first.first()["source_file"].startswith("part-")
    assert run() == 0
    arrive(trip(5))
    assert run() == 1
    assert spark.read.parquet(out).count() == 2


def test_files_of_equal_name_in_two_folders(spark, path, zones):
    import pathlib

    for folder, rows in (("a", [trip(1)]), ("b", [trip(1), trip(2)])):
        spark.createDataFrame(rows, TRIP).coalesce(1).write.parquet(path(f"new-{folder}"))
        target = pathlib.Path(path("inbox")) / folder
        target.mkdir(parents=True)
        next(pathlib.Path(path(f"new-{folder}")).glob("part-*.parquet")).rename(target / "trips.parquet")
        args = (spark, path("inbox") + "/*/*.parquet", path("manifest"), path("out"), zones, KEYS)
        assert trips.ingest_inbox(*args) == 1
        assert trips.ingest_inbox(*args) == 0
    got = spark.read.parquet(path("out"))
    assert sorted(r["VendorID"] for r in got.collect()) == [1, 1, 2]
    assert {r["source_file"] for r in got.collect()} == {"trips.parquet"}


def test_crash_before_the_manifest_leaves_no_second_copy(spark, path, zones):
    inbox, out = path("inbox"), path("out")
    spark.createDataFrame([trip()], TRIP).coalesce(1).write.parquet(inbox)
    for attempt in ("lost", "kept"):
        trips.ingest_inbox(spark, f"{inbox}/*.parquet", path(attempt), out, zones, KEYS)
    assert spark.read.parquet(out).count() == 1


# -- streams -----------------------------------------------------------------


def land(spark, path, name, rows, schema="k int, ts timestamp"):
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(path(name))


def stream(spark, path, name, schema="k int, ts timestamp"):
    return sources.read_table_stream(spark, path=path(name), schema=schema, files_per_batch=1)


def at(minutes):
    return datetime(2024, 1, 1) + timedelta(minutes=minutes)


@pytest.mark.parametrize("salted", [False, True])
@pytest.mark.parametrize("delay", [None, "1 hour"])
def test_stream_dedup_across_batches(spark, path, salted, delay):
    salt = F.unix_micros("ts") if salted else None
    for batch in ([(1, at(0)), (1, at(1)), (2, at(2))], [(1, at(3)), (3, at(4))], [(2, at(5))]):
        land(spark, path, "in", batch)
    once = streaming.dedup_stream(stream(spark, path, "in"), ["k"], "ts", delay, salt, 4)
    streaming.run_once(once, path("out"), path("ckpt"))
    assert sorted(r["k"] for r in spark.read.parquet(path("out")).collect()) == [1, 2, 3]


def test_append_new_keeps_late_rows_and_adds_none_twice(spark, path):
    batches = [[(1, at(0)), (1, at(0)), (2, at(5000))], [(3, at(1)), (2, at(5000)), (4, None)], [(1, at(0)), (4, None), (5, at(9))]]
    for k, batch in enumerate(batches):
        land(spark, path, "in", batch)
        if k != 1:
            rows = stream(spark, path, "in")
            streaming.append_new(rows, path("out"), path("ckpt"), ["k", "ts"], "ts").awaitTermination()
    assert sorted(r["k"] for r in spark.read.parquet(path("out")).collect()) == [1, 2, 3, 4, 5]
    again = stream(spark, path, "in")
    streaming.append_new(again, path("out"), path("lost-ckpt"), ["k", "ts"], "ts").awaitTermination()
    assert spark.read.parquet(path("out")).count() == 5
    with pytest.raises(ValueError):
        streaming.append_new(again, path("out"), path("c"), ["k"], "ts")


def test_stream_dedup_with_time_in_the_key(spark, path):
    land(spark, path, "in", [(1, at(0)), (1, at(0)), (1, at(1))])
    land(spark, path, "in", [(1, at(0)), (1, at(2))])
    once = streaming.dedup_stream(stream(spark, path, "in"), ["k", "ts"], "ts", "1 hour")
    streaming.run_once(once, path("out"), path("ckpt"))
    assert spark.read.parquet(path("out")).count() == 3


def test_restart_takes_only_new_files(spark, path):
    for n in (1, 1, 2):
        if n == 2 or not (spark._jvm.java.io.File(path("in")).exists()):
            land(spark, path, "in", [(n, at(n))])
        streaming.run_once(stream(spark, path, "in"), path("out"), path("ckpt"), partition_by=("k",))
        assert spark.read.parquet(path("out")).count() == n


def test_windows_close_behind_the_watermark(spark, path):
    schema = "pickup_zone string, pickup_ts timestamp, fare_amount double"
    rows = [("a", at(10), 1.0), ("a", at(50), 3.0), ("a", at(70), 5.0), ("a", at(200), 7.0)]
    land(spark, path, "in", rows, schema)
    closed = streaming.gold_stream(stream(spark, path, "in", schema), "30 minutes")
    streaming.run_once(closed, path("out"), path("ckpt"))
    got = {(r["pickup_hour"], r["trip_count"], r["avg_fare"]) for r in spark.read.parquet(path("out")).collect()}
    assert got == {(at(0), 2, 2.0), (at(60), 1, 5.0)}


def test_named_queries_can_be_found_and_stopped(spark, path):
    land(spark, path, "in", [(1, at(0))])
    query = streaming.stream_append(stream(spark, path, "in"), path("out"), path("ckpt"), trigger="1 second", name="tw_named")
    query.processAllAvailable()
    assert "tw_named" in [q.name for q in spark.streams.active]
    streaming.stop(spark, "tw_named")
    assert "tw_named" not in [q.name for q in spark.streams.active]


def test_silver_stream(spark, path, zones):
    payload = "VendorID int, tpep_pickup_datetime string, tpep_dropoff_datetime string, PULocationID int, DOLocationID int, total_amount double"
    bodies = [
        '{"VendorID": 1, "tpep_pickup_datetime": "2024-01-01 10:00:00", "tpep_dropoff_datetime": "2024-01-01 10:05:00", "PULocationID": 1, "DOLocationID": 2, "total_amount": 3.5}',
        '{"VendorID": 1, "tpep_pickup_datetime": "soon", "tpep_dropoff_datetime": "2024-01-01 10:05:00"}',
        "junk",
    ]
    spark.createDataFrame([(b, i) for i, b in enumerate([*bodies, bodies[0]])], "value string, offset bigint").coalesce(1).write.parquet(path("b"))
    bronze = sources.read_table_stream(spark, path=path("b"), schema="value string, offset bigint")
    silver = streaming.silver_stream(
        bronze, zones, payload, ["VendorID", "pickup_ts", "dropoff_ts", "PULocationID", "DOLocationID", "total_amount"],
        delay="1 hour", salt=F.col("offset"),
    )
    streaming.run_once(silver, path("s"), path("c"))
    got = spark.read.parquet(path("s")).collect()
    assert [(r["pickup_zone"], r["dropoff_borough"], r["total_amount"]) for r in got] == [("Z1", "B2", 3.5)]
