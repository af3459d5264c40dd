"""The stages one after another against plain Python on a small corpus."""

from __future__ import annotations

import random
import re

from pyspark.sql import functions as F

import corpus_pipeline
from tidewater import session
from tidewater.llm import queries

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def corpus(path, spark):
    rng = random.Random(9)
    vocabulary = ["".join(rng.choices("abcdefghij", k=rng.randint(2, 7))) for _ in range(400)]
    say = lambda n: " ".join(rng.choices(vocabulary, k=n))
    line = "this line of more than forty characters stands in many documents"
    item = say(30)
    docs = [[i, say(120)] for i in range(40)]
    docs += [[100 + i, " ".join(["!!!SHOUT", "###"] * 40)] for i in range(10)]
    docs += [[200, docs[0][1]], [201, docs[1][1] + " more"], [202, say(60) + " " + item + " " + say(40)], [203, "few words"], [204, None]]
    for i in range(6):
        docs[i + 10][1] += "\n" + line
    rows = [(i, t, "en", "s", len(t or "")) for i, t in docs]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(path("documents.parquet"))
    labels = [(i, int(i < 100), 0) for i, _ in docs if i < 30 or 100 <= i < 108]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(path("labels.parquet"))
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(path("benchmark.parquet"))
    return docs, line


def test_stages(spark, path, tmp_path):
    docs, line = corpus(path, spark)
    frame = spark.read.parquet(path("documents.parquet"))
    after = {}
    for name, stage in corpus_pipeline.STAGES:
        frame = stage(spark, frame, str(tmp_path))
        after[name] = {r["doc_id"]: r.asDict() for r in frame.collect()}
        if name != "bpe_tokens":
            assert frame.columns == COLUMNS
    good = {i for i, _ in docs if i < 100 or 200 <= i < 203}
    assert set(after["quality_rules"]) == good
    cut = {i: t for i, t in docs if i in good}
    for i in range(10, 15):
        cut[i] = cut[i].removesuffix("\n" + line)
    assert {i: r["text"] for i, r in after["line_dedup"].items()} == cut
    assert all(r["n_chars"] == len(r["text"]) for r in after["line_dedup"].values())
    assert set(after["near_dedup"]) == good - {200, 201}
    assert set(after["decontamination"]) == good - {200, 201, 202}
    tokens = after["bpe_tokens"]
    assert set(tokens) == good - {200, 201, 202}
    assert all(r["round_trip"] and len(r["ids"]) == r["n_tokens"] > 100 for r in tokens.values())
    run = corpus_pipeline.run(spark, str(tmp_path))
    assert {r["doc_id"]: r["ids"] for r in run.collect()} == {i: r["ids"] for i, r in tokens.items()}


def test_empty_and_odd_tables(spark, odd_docs, path, tmp_path):
    corpus(path, spark)
    for frame in (odd_docs, odd_docs.where("false")):
        names = frame.columns
        for name, stage in corpus_pipeline.STAGES:
            frame = stage(spark, frame, str(tmp_path))
            assert name == "bpe_tokens" or frame.columns == names
        frame.count()


def test_rows_without_an_id_and_names_that_clash(spark, path, tmp_path):
    """A contaminated document without a doc_id goes too, and columns with odd names stay."""
    docs, _ = corpus(path, spark)
    text = dict(map(tuple, docs))
    rows = [(None, text[202], 1, 7, 200), (5, text[5], 2, 8, 100), (None, None, 3, 9, 0)]
    names = "doc_id long, text string, line_stats int, `a.b` int, n_chars long"
    frame = spark.createDataFrame(rows, names)
    for stage in (corpus_pipeline.line_dedup, corpus_pipeline.near_dedup, corpus_pipeline.decontamination):
        frame = stage(spark, frame, str(tmp_path))
        assert frame.columns == ["doc_id", "text", "line_stats", "a.b", "n_chars"]
    got = frame.collect()
    assert sorted((r["line_stats"], r["a.b"], r["text"] or "") for r in got) == [(2, 8, text[5]), (3, 9, "")]


def test_no_task_runs_two_python_workers(spark, path, tmp_path, monkeypatch):
    """An executor's idle workers stay, so a task that needs two doubles what Python takes from then on."""
    corpus(path, spark)
    plans, write = [], session.staged

    def seen(df, label="stage"):
        plans.append((label, df._jdf.queryExecution().executedPlan().toString()))
        return write(df, label)

    monkeypatch.setattr(session, "staged", seen)
    tokens = corpus_pipeline.run(spark, str(tmp_path))
    plans.append(("tokens", tokens._jdf.queryExecution().executedPlan().toString()))
    python = 0
    for label, plan in plans:
        for part in plan.split("Exchange"):  # what stands between two exchanges runs in one task
            workers = len(re.findall(r"ArrowEvalPython|MapInArrow", part))
            assert workers <= 1, (label, plan)
            python += workers
    assert python >= 5


def test_every_operator_is_registered():
    assert {n.split("_")[0] for n in queries.QUERIES} == {f"op{k}" for k in range(1, 14)} | {"pipeline"}
    assert len(corpus_pipeline.STAGES) == 5 and F is not None
