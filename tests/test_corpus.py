"""Trees, embeddings, extraction and retrieval on small tables."""

from __future__ import annotations

import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewater.operators import corpus, trees
from tidewater.plans import screens
from tidewater.workloads import corpus as workload
from tidewater.workloads.corpus import letter_encoder, length_generator


def flat(spark, *docs):
    df = spark.createDataFrame([(i, d) for i, d in enumerate(docs)], "screen_id int, tree string")
    got = corpus.flatten_tree(df, "screen_id").orderBy("screen_id").collect()
    return [None if r["elements"] is None else [tuple(e) for e in r["elements"]] for r in got]


def test_walk_order_and_defaults(spark):
    tree = {
        "class": " Root ",
        "children": [
            {"text": "a", "bounds": [1, 2, 3, 4], "children": [{"text": "a1"}]},
            {"class": "", "text": "  ", "children": [{"class": "B"}]},
            "not a node",
            None,
        ],
    }
    want = [("Root", "", [0, 0, 0, 0]), ("", "a", [1, 2, 3, 4]), ("", "a1", [0, 0, 0, 0]), ("B", "", [0, 0, 0, 0])]
    wrapped = {"activity": {"root": tree}, "class": "outside"}
    assert flat(spark, json.dumps(tree), json.dumps(wrapped), "no json", None, "[]") == [want, want, None, None, []]


def test_deep_tree(spark):
    node = '{"text": "x"}'
    for _ in range(400):
        node = '{"text": "y", "children": [%s]}' % node
    assert len(flat(spark, node)[0]) == 401


def test_levels_give_the_same_rows_without_python(spark):
    deep = '{"text": "x"}'
    for i in range(9):
        deep = '{"text": "y%d", "children": [{"class": "before"}, %s, {"class": 7}]}' % (i, deep)
    texts = [
        deep, '{"activity": {"root": {"class": "in", "children": [{"text": true}, {"text": false}, 5, null, [1]]}}, "class": "out"}',
        '{"activity": [1], "class": "own"}', '{"activity": {"root": null}, "class": "own"}', "no json", None, "[]", "5", '{"children": {"a": 1}}',
        '{"class": "\\u00a0 a b\\n", "text": null, "bounds": [1, 2, 3, 4]}', '{"class": 0, "text": "t", "bounds": [1, 2, 3]}',
        '{"text": "t", "bounds": [1, 2, 3, null]}', '{"text": "t", "bounds": [1, 2, 3, 1099511627776]}', '{"text": "t", "bounds": 7}',
    ]
    df = spark.createDataFrame([(i % 12, d) for i, d in enumerate(texts)], "screen_id int, tree string")
    rows = lambda x: sorted((r["screen_id"], r["elements"] and [tuple(e) for e in r["elements"]]) for r in x.collect() if r["elements"] is not None)
    by_level = trees.flatten_tree_by_level(df, "screen_id")
    assert rows(by_level) == rows(corpus.flatten_tree(df, "screen_id"))
    assert by_level.filter("elements is null").count() == 2 and by_level.count() == len(texts)
    plan = by_level._jdf.queryExecution().executedPlan().toString()
    assert "Arrow" not in plan and "Python" not in plan
    assert trees.flatten_tree_by_level(df.limit(0), "screen_id").collect() == []


def test_nodes_are_read_once(spark, sf):
    """What is asked of the result reads stored labels, and a document is split into lines once, not once per line."""
    docs = workload._trees(spark, sf)
    assert docs._jdf.queryExecution().optimizedPlan().toString().count("split(") == 1
    plan = trees.flatten_tree_by_level(docs.limit(3), "doc_id")._jdf.queryExecution().optimizedPlan().toString()
    assert "variant" not in plan.lower()


def test_text_is_read_top_down_then_left(spark):
    nodes = [("c", "low", [0, 9, 0, 0]), ("c", "right", [5, 1, 0, 0]), ("c", "left", [2, 1, 0, 0]), ("c", "", [0, 0, 0, 0]), ("c", "again", [2, 1, 0, 0])]
    df = spark.createDataFrame([(nodes,)], f"elements {corpus.ELEMENTS}")
    assert df.select(corpus.screen_text("elements")).first()[0] == "left again right low"


def test_embedding_rows(spark):
    df = spark.createDataFrame([(1, "aab"), (2, "zzz")], "screen_id int, t string")
    got = {r["screen_id"]: r for r in corpus.embed(df, "screen_id", "t", letter_encoder(), "text", "m", "1", "r").collect()}
    assert np.linalg.norm(got[1]["embedding"]) == pytest.approx(1) and not any(got[2]["embedding"])
    assert len(got[1]["source_fingerprint"]) == 64 and got[1]["run_id"] == "r"


def test_null_content_gives_no_vector(spark):
    df = spark.createDataFrame([(1, None), (2, "a"), (3, None)], "screen_id int, t string").coalesce(1)
    for rows in (df, df.filter("t is null")):
        got = corpus.embed(rows, "screen_id", "t", letter_encoder(), "text", "m", "1").collect()
        assert all((r["embedding"] is None) == (r["screen_id"] != 2) for r in got)


def test_confidence_defaults(spark):
    outputs = ['{"confidence": 0.9}', '{"confidence": "0.4"}', '{"confidence": "high"}', "{}", "nope", None]
    made = corpus.parse_output(spark.createDataFrame([(i, o) for i, o in enumerate(outputs)], "id int, output string"))
    got = made.orderBy("id").collect()
    assert [r["confidence"] for r in got] == [0.9, 0.4, 0.0, 0.0, 0.0, 0.0]
    assert [bool(r["parsed"]) for r in got] == [True, True, True, True, False, False]
    queue = corpus.review_queue(made.withColumn("source_fingerprint", F.lit("")), "id")
    assert {(r["id"], r["reason"]) for r in queue.collect()} == {
        (1, "low_confidence"), (2, "low_confidence"), (3, "low_confidence"), (4, "unparsable"), (5, "unparsable")
    }


def test_screens_end_to_end(spark):
    meta = spark.createDataFrame(
        [(1, None, None, "f"), (2, None, None, "f")],
        "screen_id int, extraction_payload string, updated_at timestamp, source_fingerprint string",
    )
    trees = spark.createDataFrame([(1, '{"text": "hello"}')], "screen_id int, tree string")
    parsed = screens.parse_screens(meta, trees)
    made = {r["screen_id"]: r for r in screens.extract_screens(parsed, length_generator()).collect()}
    body = json.loads(made[1]["extraction_payload"])
    assert body["texts"] == "hello" and set(body["llm"]) == {"output", "prompt_version", "confidence"}
    assert made[2]["extraction_payload"] is None
    first = screens.embed_new_texts(parsed, corpus.embed(parsed.limit(0), "screen_id", "source_fingerprint", letter_encoder(), "text", "m", "1"), letter_encoder(), "m", "1")
    assert first.count() == 2
    assert screens.embed_new_texts(parsed, first, letter_encoder(), "m", "1").count() == 0
    with pytest.raises(ValueError):
        screens.parse_screens(meta, trees.unionByName(trees))


def brute_force(vectors, queries, k):
    want = set()
    unit = lambda v: np.asarray(v) / np.linalg.norm(v)
    for q, qv in queries:
        sims = sorted((-round(float(unit(qv) @ unit(v)), 9), i) for i, v in vectors if i != q)
        want |= {(q, i) for _, i in sims[:k]}
    return want


@pytest.mark.parametrize("blocks", [(5_000, 50_000), (7, 30)])
def test_nearest_is_exact_also_with_many_copies(spark, monkeypatch, blocks):
    """A third of the vectors are copies of one; one block and several agree with brute force."""
    if blocks:
        monkeypatch.setattr(corpus, "QUERY_BLOCK", blocks[0])
        monkeypatch.setattr(corpus, "CORPUS_BLOCK", blocks[1])
    rng = np.random.default_rng(3)
    data = [(i, [1.0, 2.0, 3.0] if i % 3 == 0 else [float(x) for x in rng.integers(-9, 9, 3) + 0.5]) for i in range(90)]
    df = spark.createDataFrame([(i, v, i % 4) for i, v in data], "corpus_id bigint, embedding array<float>, corpus_label int")
    asked = df.select(F.col("corpus_id").alias("query_id"), "embedding")
    got = {(r["query_id"], r["corpus_id"]) for r in corpus.nearest(df, asked, 5).collect()}
    assert got == brute_force(data, data, 5)


def test_recall_of_all_vectors(spark, sf):
    """Each vector asks for its own label, against brute force."""
    vectors = spark.read.parquet(f"{sf}/embeddings.parquet")
    local = vectors.toPandas()
    rows = np.stack(local["embedding"].to_numpy()).astype("float64")
    rows /= np.linalg.norm(rows, axis=1, keepdims=True)
    sims = np.round(rows @ rows.T, corpus.SIMILARITY_DIGITS)
    np.fill_diagonal(sims, -np.inf)
    labels, ids = local["label"].to_numpy(), local["vec_id"].to_numpy()
    scores = []
    for i in range(len(ids)):
        best = np.lexsort((ids, -sims[i]))[:5]
        scores.append((labels[best] == labels[i]).sum() / ((labels == labels[i]).sum() - 1))
    got = corpus.recall_at_k(vectors, vectors, version="v").first()
    assert got["n_queries"] == len(ids) and got["recall_at_5"] == pytest.approx(np.mean(scores))


def test_changed(spark):
    old = corpus.embed(spark.createDataFrame([(1, "a"), (2, "b")], "k int, t string"), "k", "t", letter_encoder(), "text", "m", "1")
    new = spark.createDataFrame([(1, "a"), (2, "c"), (3, "d")], "k int, t string")
    assert [r["k"] for r in corpus.changed(old, new, "k", "t").collect()] == [2]


def test_no_tree_ends_the_job(spark):
    deep = "[" * 200_000
    bounds = ["[null, 1, 2, 3]", '"wide"', "7", "[1, 2, 3]", f"[0, 0, 1, {2**40}]", "[1, 2, 3, 4]", "[1e400, 0, 0, 0]"]
    trees = [f'{{"class": "a", "text": "t", "bounds": {b}}}' for b in bounds]
    df = spark.createDataFrame(enumerate([*trees, deep, None, ""]), "k int, tree string")
    got = {r["k"]: r["elements"] for r in corpus.flatten_tree(df, "k").collect()}
    assert [list(got[i][0]["bounds"]) for i in range(len(bounds))] == [[0] * 4] * 5 + [[1, 2, 3, 4], [0] * 4]
    assert [got[i] for i in range(len(bounds), len(bounds) + 3)] == [None] * 3


def test_no_confidence_goes_to_review(spark):
    made = corpus.parse_output(
        spark.createDataFrame([(1, '{"confidence": "NaN"}'), (2, '{"confidence": 0.9}'), (3, "no")], "k int, output string")
    ).withColumn("source_fingerprint", F.lit("f"))
    assert {r["k"] for r in corpus.review_queue(made, "k").collect()} == {1, 3}
