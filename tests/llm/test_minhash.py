from __future__ import annotations

import random

import numpy as np
from pyspark.sql import functions as F

from tidewater.llm import buckets, minhash
from tidewater.llm.components import components
from tidewater.llm.words import pieces, shingles, words_of


def sets(texts):
    items, of, weights = minhash.weighted(*shingles(words_of(texts), 5))
    return [(items[of == d], weights[of == d].astype(float)) for d in range(len(texts))]


def stated(x, y):
    """Probability Jaccard as it is defined."""
    x, y = (dict(zip(items.tolist(), w.tolist())) for items, w in (x, y))
    every = set(x) | set(y)
    return sum(
        1 / sum(max(x.get(e, 0) / x[d], y.get(e, 0) / y[d]) for e in every) for d in set(x) & set(y)
    )


def near_texts():
    rng = random.Random(6)
    word = lambda: "".join(rng.choices("abcdefgh", k=rng.randint(1, 6)))
    texts = []
    for _ in range(40):
        base = [word() for _ in range(rng.randint(5, 300))]
        texts.append(" ".join(base))
        for _ in range(rng.randint(0, 4)):
            copy = list(base)
            for _ in range(rng.randint(0, max(1, len(base) // 25))):
                copy[rng.randrange(len(copy))] = word()
            texts.append(" ".join(copy).upper() if rng.random() < 0.2 else " ".join(copy))
    return texts


def classes_by_brute_force(rows, threshold):
    kept = [(i, s) for (i, t), s in zip(rows, sets([t for _, t in rows]))]
    parent = {i: i for i, _ in kept}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, (i, x) in enumerate(kept):
        for j, y in kept[:a]:
            if len(x[0]) and stated(x, y) >= threshold - 1e-9:
                a_root, b_root = sorted((root(i), root(j)))
                parent[b_root] = a_root
    return {i: root(i) for i, _ in kept}


def test_similarity_and_estimate():
    rng = np.random.default_rng(1)
    worst = []
    for _ in range(60):
        x, y = (np.unique(rng.integers(0, 60, rng.integers(1, 60))) for _ in range(2))
        a, b = (x.astype(np.uint64), rng.integers(1, 4, len(x)).astype(float)), (y.astype(np.uint64), rng.integers(1, 4, len(y)).astype(float))
        assert abs(buckets.similarity(*a, *b) - stated(a, b)) < 1e-9
        items, docs = np.concatenate([a[0], b[0]]), np.repeat([0, 1], [len(x), len(y)])
        held = minhash.signatures(items, docs, np.concatenate([a[1], b[1]]), 2, 512)
        worst.append(abs((held[0] == held[1]).mean() - stated(a, b)))
    assert max(worst) < 0.1 and np.mean(worst) < 0.025


def test_classes_against_brute_force(spark):
    rows = list(enumerate(near_texts()))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r[0]: r[1] for r in minhash.near_duplicates(df).collect()}
    assert got == classes_by_brute_force(rows, 0.8)


def test_strays_of_a_bucket_are_linked(spark):
    """Four sets in one bucket: the leader is like none of the others, two of which are alike."""
    sets_of = [(1, list(range(100, 120))), (2, list(range(10))), (3, list(range(1, 11))), (4, list(range(50, 60)))]
    table = spark.createDataFrame([(n, i, [1] * len(i)) for n, i in sets_of], "node long, items array<long>, weights array<int>")
    members = spark.createDataFrame([(7, n) for n, _ in sets_of] + [(7, 2)], "bucket long, node long")
    links, labels = buckets.link(members, lambda nodes: table.join(nodes, "node"), 0.8)
    assert {(r["a"], r["b"]) for r in links.collect()} == {(2, 3)}
    assert {tuple(r) for r in labels.collect()} == {(3, 2)}


def test_bounds_leave_no_similar_pair_out(spark):
    """Weighted sets around the threshold: what the parities rule out is below it, and little else passes."""
    rng = np.random.default_rng(12)
    rows, want, low = [], set(), set()
    for k in range(400):
        n = int(rng.integers(5, 200))
        x = dict(zip(rng.choice(10**12, n, replace=False).tolist(), rng.choice([1, 1, 1, 2, 5], n).tolist()))
        y = dict(x)
        for e in list(x)[: int(rng.integers(0, max(2, n // 3)))]:
            change = rng.integers(0, 4)
            if change == 0:
                del y[e]
            elif change == 1:
                y[e] = int(rng.integers(1, 4))
            else:
                del y[e]
                y[int(rng.integers(10**12))] = 1
        sides = [(np.array(sorted(s), np.uint64), np.array([s[e] for e in sorted(s)], float)) for s in (x, y)]
        if stated(*sides) >= 0.8:
            want.add(k)
        elif stated(*sides) < 0.6:
            low.add(k)
        rows.append((k, *(v for items, w in sides for v in (items.astype(np.int64).tolist(), int(w.sum())))))
    frame = spark.createDataFrame(rows, "k int, a array<long>, a_all long, b array<long>, b_all long")
    frame = frame.select("k", buckets.parities(F.col("a")).alias("a"), "a_all", buckets.parities(F.col("b")).alias("b"), "b_all")
    allowed = buckets._parities_allow(F.col("a"), F.col("a_all"), F.col("b"), F.col("b_all"), 0.8)
    got = {r["k"] for r in frame.where(allowed).collect()}
    assert want <= got and len(want) > 50 and len(got & low) <= len(low) // 4


def test_a_loose_group_has_few_candidates(spark, monkeypatch):
    """Hundreds of sets in one bucket that differ from their base, some of them alike, none like the leader."""
    rng = np.random.default_rng(13)
    base = np.arange(1000, 1200)
    table = [(0, list(range(200)))]
    for k in range(1, 301):
        own = base.copy()
        own[rng.choice(200, 40, replace=False)] = k * 10_000 + np.arange(40)
        table.append((k, sorted(own.tolist())))
        if k % 10 == 0:
            copy = own.copy()
            copy[:5] = 5_000_000 + k * 100 + np.arange(5)
            table.append((1000 + k, sorted(copy.tolist())))
    sets_of = spark.createDataFrame([(n, i, [1] * len(i)) for n, i in table], "node long, items array<long>, weights array<int>")
    members = spark.createDataFrame([(7, n) for n, _ in table], "bucket long, node long")
    seen = []
    monkeypatch.setattr(buckets, "_verified", lambda pairs, *a, f=buckets._verified: seen.append(pairs.count()) or f(pairs, *a))
    _, labels = buckets.link(members, lambda nodes: sets_of.join(nodes, "node"), 0.8)
    assert {tuple(r) for r in labels.collect()} == {(1000 + k, k) for k in range(10, 301, 10)}
    assert seen[-1] < 2000


def test_rows_are_left_out_before_a_join_and_no_wanted_one(spark):
    keys = spark.range(-30_000, 30_000).select(F.when(F.col("id") != 7, F.col("id") * 10_007).alias("k"), F.lit("t").alias("text"))
    wanted = keys.where("k % 90063 = 0").select("k")  # every ninth one
    left = buckets.likely(keys, "k", wanted)
    assert left.columns == ["k", "text"] and left.join(wanted, "k", "left_semi").count() == wanted.count() > 6000
    assert left.count() < wanted.count() * 1.1
    assert buckets.likely(keys, "k", wanted.limit(0)).isEmpty()
    assert "hashpartitioning(k" not in left._jdf.queryExecution().executedPlan().toString()


def test_components(spark):
    rng = random.Random(2)
    edges = [(k, k + 1) for k in range(100, 140)] + [(1, k) for k in range(2, 60)] + [(rng.randint(200, 260), rng.randint(200, 260)) for _ in range(40)]
    edges += [(5, 5), (None, 3), (2, 1)]
    got = {r["node"]: r["label"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    want = {}
    for a, b in edges:
        if a is not None:
            for n in (a, b):
                want.setdefault(n, n)
    for _ in want:
        for a, b in edges:
            if a is not None:
                want[a] = want[b] = min(want[a], want[b])
    assert got == {n: v for n, v in want.items() if n != v}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_odd_rows(odd_docs, no_docs):
    rows = minhash.near_duplicates(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    got = {r["doc_id"]: r["class_id"] for r in rows}
    assert got[None] is None and all(got[i] == i for i in (0, 1, 2, 3, 4, 6, 7, 8, 9, 20))
    kept = minhash.one_of_each(odd_docs, minhash.near_duplicates(odd_docs))
    assert kept.columns == odd_docs.columns
    ids = [r["doc_id"] for r in kept.collect()]
    assert sorted(map(repr, ids)) == sorted(map(repr, {r["doc_id"] for r in rows}))
    assert minhash.near_duplicates(no_docs).count() == 0
    assert minhash.one_of_each(no_docs, minhash.near_duplicates(no_docs)).count() == 0


def test_pieces_cover_all():
    texts = ["x" * n for n in (10, 0, 5_000_000, 3, 2_000_000)] + [None]
    assert [t for a, b in pieces(texts) for t in texts[a:b]] == texts
    assert list(pieces([])) == [] and F is not None


def test_similarity_of_sets_without_weights_is_that_of_weighted_ones():
    rng = np.random.default_rng(5)
    sides = [[np.unique(rng.integers(0, 40, n)).astype(np.int64) for n in rng.integers(0, 30, 200)] for _ in range(2)]
    ends = [np.r_[3, 3 + np.cumsum([len(x) for x in side])] for side in sides]  # as in a slice of a column
    got = buckets._plain(*(v for side, e in zip(sides, ends) for v in (np.concatenate([np.zeros(3, np.int64), *side]), e)))
    assert np.allclose(got, [buckets.similarity(x, np.ones(len(x)), y, np.ones(len(y))) for x, y in zip(*sides)])
