"""Merges by bucket, consumed offsets, checksums, audits before publication, and the retrieval index."""

from __future__ import annotations

import os
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewater.errors import DataQualityError
from tidewater.operators import cdc, checksums, history, offsets, retrieval
from tidewater.operators.quality import TableChecks
from tidewater.plans import bucketed
from tidewater.plans.publish import findings, publish
from tidewater.plans.replicate import Replication, replicate
from tidewater.session import staged


def files(path):
    """Data files below a path with their time of change."""
    out = {}
    for folder, _, names in os.walk(path):
        for n in names:
            if n.startswith("part-"):
                out[os.path.relpath(f"{folder}/{n}", path)] = os.stat(f"{folder}/{n}").st_mtime_ns
    return out


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


# -- merges by bucket --------------------------------------------------------


def test_only_touched_buckets_are_rewritten(spark, path):
    base = spark.range(1000).select(F.col("id").alias("k"), F.lit("old").alias("v"))
    bucketed.upsert_bucketed(spark, path("t"), base, ["k"], 32)
    before = files(path("t"))
    batch = spark.createDataFrame([(3, "new"), (5000, "new")], "k long, v string")
    hit = bucketed.upsert_bucketed(spark, path("t"), batch, ["k"], 32)
    after = files(path("t"))
    of = lambda name: int(name.split("/")[0].split("=")[1])
    assert len(hit) == 2 and {of(n) for n in set(before) ^ set(after)} == set(hit)
    assert all(after[n] == t for n, t in before.items() if of(n) not in hit)
    want = [(i, "new" if i == 3 else "old") for i in range(1000)] + [(5000, "new")]
    assert rows_of(bucketed.read_bucketed(spark, path("t"), 32)) == sorted(want, key=repr)


def test_target_is_read_by_partition(spark, path):
    base = spark.range(100).select(F.col("id").alias("k"), F.lit("old").alias("v"))
    bucketed.write_bucketed(base, path("t"), ["k"], 8)
    plan = bucketed.read_bucketed(spark, path("t"), 8, [1, 2])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [bucket_of_8" in plan
    with pytest.raises(ValueError, match="not a table of 16 buckets"):
        bucketed.read_bucketed(spark, path("t"), 16)


def test_upserts_again_change_nothing_and_repeated_keys_are_refused(spark, path):
    base = spark.createDataFrame([(1, "a"), (2, "b"), (None, "n")], "k long, v string")
    bucketed.upsert_bucketed(spark, path("t"), base, ["k"], 4)
    batch = spark.createDataFrame([(2, "c"), (3, "d")], "k long, v string")
    for _ in range(2):
        bucketed.upsert_bucketed(spark, path("t"), batch, ["k"], 4)
    want = [(1, "a"), (2, "c"), (3, "d"), (None, "n")]
    assert rows_of(bucketed.read_bucketed(spark, path("t"), 4)) == sorted(want, key=repr)
    before = files(path("t"))
    with pytest.raises(ValueError, match="repeats"):
        bucketed.upsert_bucketed(spark, path("t"), batch.union(batch), ["k"], 4)
    assert bucketed.upsert_bucketed(spark, path("t"), batch.limit(0), ["k"], 4) == []
    assert files(path("t")) == before


def test_a_hot_key_range_of_composite_keys(spark, path):
    """Two key columns, one of them the same in all rows."""
    base = spark.range(50).select(F.lit("hot").alias("a"), F.col("id").alias("b"), F.lit(0).alias("v"))
    bucketed.upsert_bucketed(spark, path("t"), base, ["a", "b"], 4)
    bucketed.upsert_bucketed(spark, path("t"), base.filter("b < 5").withColumn("v", F.lit(1)), ["a", "b"], 4)
    got = bucketed.read_bucketed(spark, path("t"), 4)
    assert got.count() == 50 and got.agg(F.sum("v")).first()[0] == 5


def test_buckets_that_deletes_empty_go(spark, path):
    empty = spark.createDataFrame([], "id long, name string, ms long")
    schema = "entity_id long, op string, after_name string, ts_ms long"
    values = {"name": "after_name", "ms": "ts_ms"}
    put = spark.createDataFrame([(i, "c", f"n{i}", 1) for i in range(6)], schema)
    bucketed.merge_cdc_bucketed(spark, path("t"), put, "id", values, 64, empty)
    gone = spark.createDataFrame([(i, "d", None, 2) for i in range(5)] + [(99, "d", None, 2), (None, "c", "x", 2)], schema)
    bucketed.merge_cdc_bucketed(spark, path("t"), gone, "id", values, 64, empty)
    assert rows_of(bucketed.read_bucketed(spark, path("t"), 64)) == [(5, "n5", 1)]
    assert len(files(path("t"))) == 1


# -- consumed offsets --------------------------------------------------------


def by_hand(points):
    out = []
    for topic, part, o in sorted(points):
        if out and out[-1][:2] == (topic, part) and out[-1][3] == o - 1:
            out[-1] = (topic, part, out[-1][2], o)
        else:
            out.append((topic, part, o, o))
    return out


@pytest.mark.parametrize("chunk", [4, 65_536])
def test_intervals_by_hand(spark, monkeypatch, chunk):
    monkeypatch.setattr(offsets, "CHUNK", chunk)
    random.seed(5)
    points = [{(t, p, random.randrange(60)) for _ in range(n)} for t, p, n in (("a", 0, 40), ("a", 1, 70), ("b", 0, 5))]
    one, two = ({x for s in points for x in s if random.random() < 0.6} for _ in range(2))
    frame = lambda s: spark.createDataFrame(sorted(s) * 2 or [], "topic string, partition int, offset long")
    sets = [offsets.intervals_of(frame(s)) for s in (one, two)]
    assert [rows_of(s) for s in sets] == [sorted(by_hand(s), key=repr) for s in (one, two)]
    assert rows_of(offsets.union_intervals(*sets)) == sorted(by_hand(one | two), key=repr)
    everything = {x for s in points for x in s}
    left = offsets.not_consumed(frame(everything), sets[0])
    assert rows_of(left) == sorted([tuple(x) for x in everything - one] * 2, key=repr)
    whole = {(t, p): [o for a, b, o in one if (a, b) == (t, p)] for t, p, _ in one}
    missing = {(t, p, o) for (t, p), os_ in whole.items() for o in range(min(os_), max(os_)) if o not in os_}
    assert rows_of(offsets.gaps(sets[0])) == sorted(by_hand(missing), key=repr)


def test_records_without_a_place_count_as_new(spark):
    schema = "topic string, partition int, offset long"
    batch = spark.createDataFrame([("a", 0, 1), ("a", 0, None), (None, 0, 1), ("a", None, 1)], schema)
    consumed = offsets.intervals_of(batch)
    assert rows_of(consumed) == [("a", 0, 1, 1)]
    assert offsets.not_consumed(batch, consumed).count() == 3
    assert offsets.intervals_of(batch.limit(0)).collect() == []
    assert offsets.not_consumed(batch, consumed.limit(0)).count() == 4


def test_batches_overlap_repeat_and_die_half_way(spark, path):
    frame = lambda ids: spark.createDataFrame(
        [("t", 0, i, f"v{i}") for i in ids], "topic string, partition int, offset long, value string"
    )
    place = path("bronze"), path("offsets")
    assert offsets.read_offsets(spark, path("offsets")).collect() == []
    offsets.append_consumed(frame([10, 11, 12, 12]), *place, 0)
    offsets.append_consumed(frame([1, 2, 11]), *place, 1)
    # A run that died before it wrote its offsets: the records are there, the offsets are not.
    frame([20, 21]).write.parquet(path("bronze") + "/batch_id=2")
    offsets.append_consumed(frame([12, 20, 21]), *place, 2)
    offsets.append_consumed(frame([1, 2, 11]), *place, 1)
    stored = spark.read.parquet(path("bronze"))
    assert sorted(r["offset"] for r in stored.collect()) == [1, 2, 10, 11, 12, 20, 21]
    want = [("t", 0, 1, 2), ("t", 0, 10, 12), ("t", 0, 20, 21)]
    assert rows_of(offsets.read_offsets(spark, path("offsets"))) == sorted(want, key=repr)


def test_records_of_a_batch_are_shuffled_and_written_once(spark, path, monkeypatch):
    frame = lambda ids: spark.createDataFrame(
        [("t", 0, i, f"v{i}") for i in ids], "topic string, partition int, offset long, value string"
    )
    offsets.append_consumed(frame([1, 2]), path("bronze"), path("offsets"), 0)
    plans, replace = [], offsets._replace

    def seen(rows, folder, batch_id):
        plans.append(rows._jdf.queryExecution().optimizedPlan().toString())
        replace(rows, folder, batch_id)

    monkeypatch.setattr(offsets, "_replace", seen)
    offsets.append_consumed(frame([2, 3, 3]), path("bronze"), path("offsets"), 1)
    # The records go straight into bronze: copies are dropped behind the join with what is stored, not before it and once more for its keys.
    assert plans[0].index("Aggregate [") < plans[0].index("LeftAnti")
    assert sum("first(value" in line for line in plans[0].splitlines()) == 1
    assert sorted(r["offset"] for r in spark.read.parquet(path("bronze")).collect()) == [1, 2, 3]


# -- checksums ---------------------------------------------------------------


def sides(spark):
    source = [(i, f"n{i}", i % 7) for i in range(400)] + [(None, "x", 1), (500, None, None), (500, None, None)]
    mirror = [r for r in source if r[0] not in (3, 4)]
    mirror = [(k, "other" if k == 10 else n, v) for k, n, v in mirror] + [(900, "extra", 0), (500, None, None)]
    schema = "k long, n string, v int"
    return spark.createDataFrame(source, schema), spark.createDataFrame(mirror, schema)


def test_checksums_find_what_rows_differ(spark):
    source, mirror = sides(spark)
    want = rows_of(cdc.reconcile_rows(source, mirror, ["k"], ["n", "v"]))
    assert {r[0] for r in want} == {3, 4, 10, 500, 900}
    for buckets, fine in ((1, 1), (8, 4), (1024, 256)):
        assert rows_of(checksums.reconcile_tree(source, mirror, ["k"], ["n", "v"], buckets, fine)) == want
    assert checksums.reconcile_tree(source, source, ["k"], ["n", "v"]).collect() == []
    assert checksums.reconcile_tree(source.limit(0), mirror.limit(0), ["k"], ["n", "v"]).collect() == []


def test_null_and_empty_are_different_values(spark):
    a = spark.createDataFrame([(1, None, "x"), (2, "", None)], "k int, n string, v string")
    b = spark.createDataFrame([(1, "x", None), (2, None, "")], "k int, n string, v string")
    assert {r["k"] for r in checksums.reconcile_tree(a, b, ["k"], ["n", "v"], 2).collect()} == {1, 2}


def test_only_buckets_that_differ_are_read(spark, path):
    """With stored checksums the files of equal buckets may even be gone."""
    source, mirror = (df.filter("k is not null") for df in sides(spark))
    tables = {}
    for name, df in (("source", source), ("mirror", mirror)):
        bucketed.write_bucketed(df, path(name), ["k"], 16)
        tables[name] = spark.read.parquet(path(name))
    want = rows_of(cdc.reconcile_rows(source, mirror, ["k"], ["n", "v"]))
    sums = {n: staged(checksums.bucket_checksums(t, ["k"], ["n", "v"], 16), n) for n, t in tables.items()}
    odd = {r["bucket"] for r in checksums.differing(sums["source"], sums["mirror"]).collect()}
    assert 0 < len(odd) < 16
    for name in tables:
        for file in files(path(name)):
            if int(file.split("/")[0].split("=")[1]) not in odd:
                os.remove(f"{path(name)}/{file}")
    got = checksums.reconcile_tree(
        tables["source"], tables["mirror"], ["k"], ["n", "v"], 16,
        source_sums=sums["source"], mirror_sums=sums["mirror"],
    )
    assert rows_of(got) == want


# -- audit before publication ------------------------------------------------


def test_findings():
    cfg = TableChecks("t", "k", ["v"], 0.1, 5)
    assert findings(cfg, 10, {"v": 1}, 0) == []
    assert [s for s, _ in findings(cfg, 4, {"v": 4}, 2)] == ["CRITICAL", "CRITICAL", "WARNING"]
    assert [s for s, _ in findings(cfg, 0, {"v": 0}, 0)] == ["CRITICAL"]


def test_a_batch_that_fails_is_never_seen(spark, path):
    cfg = TableChecks("t", "k", ["v"])
    good = spark.range(20).select(F.col("id").alias("k"), F.lit("a").alias("v"), (F.col("id") % 2).alias("p"))
    publish(good, path("t"), cfg, path("a"), ("p",))
    before = files(path("t"))
    for bad in (good.union(good), good.limit(0)):
        with pytest.raises(DataQualityError):
            publish(bad, path("t"), cfg, path("a"), ("p",))
    assert files(path("t")) == before
    publish(good.filter("p = 1").withColumn("v", F.lit(None).cast("string")), path("t"), cfg, path("a"), ("p",))
    got = spark.read.parquet(path("t"))
    assert got.count() == 20 and got.filter("v is null").count() == 10
    assert sorted(r["severity"] for r in spark.read.parquet(path("a")).collect()) == ["CRITICAL", "CRITICAL", "WARNING"]


def test_a_replication_that_its_audit_refuses_leaves_table_and_ledger(spark, path):
    from datetime import date

    def run(day, name, ids):
        users = spark.createDataFrame([(i, f"{i}@x") for i in ids], "user_id int, email string")
        users.write.option("header", True).csv(path(name))
        cfg = Replication("users", "user_id", path(name), path("h"), path("l"), ["email"], path("a"), users.schema)
        return replicate(spark, cfg, date(2024, 5, day))

    _, first = run(1, "one", range(100))
    with pytest.raises(DataQualityError, match="more than once"):
        run(2, "two", [None, None])
    assert history.current_snapshot_id(spark, path("h")) == first
    assert history.read_ledger(spark, path("l")).count() == 1 and spark.read.parquet(path("a")).count() == 1
    _, third = run(3, "three", range(90, 110))
    assert history.state_at(spark, path("h"), third).count() == 110


# -- retrieval index ---------------------------------------------------------


@pytest.fixture(scope="module")
def clustered():
    """Vectors around 12 directions, a third of all rows one and the same vector."""
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(12, 16))
    v = centres[rng.integers(0, 12, 900)] + 0.25 * rng.normal(size=(900, 16))
    v[600:] = v[0]
    return v


def frame(spark, vectors):
    rows = [(i, [float(c) for c in v], i % 3) for i, v in enumerate(vectors)]
    return spark.createDataFrame(rows, "corpus_id long, embedding array<float>, corpus_label int")


def asked(df, of=50):
    return df.filter(F.col("corpus_id") % of == 0).select(F.col("corpus_id").alias("query_id"), "embedding")


def brute(vectors, ids, k):
    unit = np.float32(vectors).astype(float)
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    out = {}
    for i in ids:
        sims = np.round(unit @ unit[i], 9)
        sims[i] = -np.inf
        out[i] = sorted(zip(-sims, range(len(sims))))[:k]
    return out


def test_exact_search_is_brute_force(spark, path, clustered, monkeypatch):
    monkeypatch.setattr(retrieval, "CORPUS_BLOCK", 100)
    monkeypatch.setattr(retrieval, "QUERY_BLOCK", 7)
    df = frame(spark, clustered)
    index = retrieval.build_index(df, path("lists"), 12)
    assert index.sizes.sum() == 900
    want = brute(clustered, range(0, 900, 50), 5)
    got = retrieval.search_exact(index, asked(df), 5, 1).collect()
    assert len(got) == 5 * len(want)
    for r in got:
        sim, at = want[r["query_id"]][r["place"] - 1]
        assert r["corpus_id"] == at and abs(r["sim"] + sim) < 1e-8


def test_few_lists_give_the_recall_on_vectors_with_structure(spark, path, clustered):
    df = frame(spark, clustered)
    index = retrieval.build_index(df, path("lists"), 24)
    probes = retrieval.probes_for(retrieval.sample_of(df, 500), index.centroids, 5, 0.95)
    assert probes <= 6
    found, exact = retrieval.search(index, asked(df), 5, probes), retrieval.search_exact(index, asked(df), 5, probes)
    row = retrieval.search_recall(index, found, exact, probes).first()
    assert row["n_queries"] == 18 and row["recall"] >= 0.9
    assert row["most_candidates"] <= np.sort(index.sizes)[::-1][:probes].sum()


def test_vectors_without_a_direction_and_empty_tables(spark, path):
    nan = float("nan")
    rows = [(0, [1.0, 0.0]), (1, [0.0, 1.0]), (2, None), (3, [nan, 1.0]), (4, [0.0, 0.0]), (5, [1.0, None]), (6, [1.0, 0.1])]
    df = spark.createDataFrame([(i, v, None) for i, v in rows], "corpus_id long, embedding array<double>, corpus_label int")
    index = retrieval.build_index(df, path("lists"), 3)
    got = retrieval.search_exact(index, asked(df, 1), 2, 1).collect()
    assert {(r["query_id"], r["place"], r["corpus_id"]) for r in got} == {
        (0, 1, 6), (0, 2, 1), (1, 1, 6), (1, 2, 0), (6, 1, 0), (6, 2, 1),
    }
    none = retrieval.build_index(df.limit(0), path("none"), 3)
    assert retrieval.search_exact(none, asked(df, 1), 2, 1).collect() == []
    assert retrieval.search(none, asked(df, 1), 2, 1).collect() == []
