from __future__ import annotations

import random

import numpy as np
from pyspark.sql import functions as F

from tidewater.llm import passages
from tidewater.llm.staging import staged
from tidewater.llm.words import words_of


def texts():
    rng = random.Random(8)
    word = lambda: "".join(rng.choices("abcdefghij", k=rng.randint(1, 7)))
    say = lambda n: [word() for _ in range(n)]
    shared, edited = say(52), say(120)
    rows = []
    for i in range(30):
        own = say(rng.randint(60, 200))
        at = rng.randrange(len(own))
        if i % 3 == 0:
            own[at:at] = shared
        if i % 5 == 0:
            copy = list(edited)
            copy[60] = word()
            own[at:at] = copy
        rows.append((i, " ".join(own).replace(" a", "\na")))
    return rows, {i for i in range(30) if i % 3 == 0 or i % 5 == 0}


def test_shared_passages_are_found_and_no_others(spark):
    rows, want = texts()
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    found = passages.repeats(df).collect()
    assert {r["doc_id"] for r in found} == want
    text = dict(rows)
    by_class = {}
    for r in found:
        by_class.setdefault(r["class_id"], []).append(r)
        assert len(text[r["doc_id"]][r["start"] : r["end"]].split()) == passages.LENGTH
    for members in by_class.values():
        assert [r["doc_id"] for r in members if r["kept"]] == [min(r["doc_id"] for r in members)]


def test_copies_within_one_task(spark):
    rows, _ = texts()
    rows = [(1, rows[1][1]), (2, rows[2][1]), (3, rows[1][1]), (4, rows[4][1])]
    df = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    found = passages.repeats(df).collect()
    assert {r["doc_id"] for r in found} == {1, 3}
    assert {r["doc_id"] for r in found if r["kept"]} == {1}


def test_one_of_each_passage_stays(spark):
    rows, _ = texts()
    df = spark.createDataFrame(rows, "doc_id long, text string")
    spans = passages.removals(passages.repeats(df))
    cut = df.join(spans, "doc_id", "left").select("doc_id", passages.cut(F.col("text"), F.col("spans")).alias("text"))
    assert passages.repeats(cut).count() == 0
    assert {r["doc_id"]: r["text"] for r in cut.collect()}[1] == rows[1][1]


def test_odd_rows(odd_docs, no_docs, spark):
    assert {r["doc_id"] for r in passages.repeats(odd_docs).collect()} == set()
    assert passages.repeats(no_docs).count() == 0
    twice = odd_docs.unionByName(odd_docs.withColumn("doc_id", F.col("doc_id") + 100))
    assert {r["doc_id"] for r in passages.repeats(twice).collect()} == {4, 104, 6, 106}
    cut = odd_docs.select(passages.cut(F.col("text"), F.lit(None).cast("array<struct<start:int,end:int>>")).alias("x"), "text")
    assert cut.where("not (x <=> text)").count() == 0


def test_texts_of_one_id_are_cut_each_by_its_own_places(spark):
    rng = random.Random(23)
    word = lambda: "".join(rng.choices("abcdefghij", k=6))
    say = lambda n: [word() for _ in range(n)]
    shared = say(60)
    rows = [(1, " ".join([*say(30), *shared])), (7, " ".join([*say(80), *shared, *say(40)])), (7, " ".join([*shared, *say(90)]))]
    rows += [rows[1], (8, rows[2][1] + " more"), (9, rows[0][1])]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("text_hash", F.xxhash64("text"))
    found = staged(passages.repeats(df), "found")
    places = {(r["doc_id"], r["text_hash"]) for r in found.collect()}
    assert places == {(r["doc_id"], r["text_hash"]) for r in df.collect()}
    by_text = {(r["doc_id"], r["text_hash"]): r["text"] for r in df.collect()}
    at = {}
    for r in found.collect():
        said = by_text[r["doc_id"], r["text_hash"]][r["start"] : r["end"]]
        assert len(said.split()) == passages.LENGTH and at.setdefault(r["class_id"], said) == said
    cut = df.join(passages.removals(found), ["doc_id", "text_hash"], "left")
    left = cut.select("doc_id", passages.cut(F.col("text"), F.col("spans")).alias("text")).collect()
    assert {r["text"] for r in left if r["doc_id"] == 1} == {rows[0][1]}
    sizes = sorted(len(r["text"].split()) for r in left if r["doc_id"] == 7)
    assert sizes[0] < 150 and all(n < 180 for n in sizes)
    assert passages.repeats(df.where("doc_id = 7")).count() == 0


def test_links_in_a_crowded_band_equal_brute_force(spark):
    rng = random.Random(17)
    word = lambda: "".join(rng.choices("abcdefghij", k=6))
    phrase, rows = [word() for _ in range(20)], []
    for i in range(150):  # each has its own five words after a phrase of all; its edited copy lacks the last of them
        own = [word() for _ in range(5)]
        rows += [(2 * i, phrase + own), (2 * i + 1, phrase + own[:4] + [word()])]
    sets = {i: {tuple(t[k : k + 5]) for k in range(21)} for i, t in rows}
    links = {(a, b) for a in sets for b in sets if a < b and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])}
    df = spark.createDataFrame([(i, " ".join(t)) for i, t in rows], "doc_id long, text string").repartition(3)
    classes = {}
    for r in passages.repeats(df).collect():
        classes.setdefault(r["class_id"], []).append(r["doc_id"])
    assert links == {(2 * i, 2 * i + 1) for i in range(150)}
    assert sorted(map(sorted, classes.values())) == sorted(map(list, links))


def test_passages_within_templates_share_a_paragraph():
    rng = random.Random(21)
    word = lambda: "".join(rng.choices("abcdefghij", k=6))
    for k in range(200):
        fixed = [word() for _ in range(rng.randint(4, 12))]
        records = lambda n: [w for _ in range(n) for w in [*fixed, *(word() for _ in range(rng.randint(0, 4)))]]
        shared = (fixed * 20 if k % 2 else records(20))[:52]
        docs = [" ".join([*records(rng.randint(0, 9)), *shared, *records(rng.randint(0, 9))]) for _ in range(2)]
        contents = [set(passages.paragraphs(words_of([d]), passages.LENGTH, 1, 1)[1].tolist()) for d in docs]
        assert contents[0] & contents[1]


def test_a_passage_that_repeats_itself_is_found_whole(spark):
    rng = random.Random(22)
    word = lambda: "".join(rng.choices("abcdefghij", k=6))
    own = lambda: [word() for _ in range(60)]
    rows = [(i, " ".join([*own(), *["one two three four five six seven"] * 40, *own()])) for i in range(3)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    found = staged(passages.repeats(df), "found")
    text, at = dict(rows), {i: t.index("one two") for i, t in rows}
    size = len("one two three four five six seven") * 40 + 39
    covered = {i: np.zeros(len(t), bool) for i, t in rows}
    for r in found.collect():
        covered[r["doc_id"]][r["start"] : r["end"]] = True
    for i in covered:
        assert covered[i][at[i] : at[i] + size].mean() > 0.9
    cut = df.join(passages.removals(found), "doc_id").select("doc_id", passages.cut(F.col("text"), F.col("spans")).alias("text"))
    left = {r["doc_id"]: r["text"].split() for r in cut.collect()}
    assert 120 + 25 <= len(left[0]) <= 120 + 25 + 14
    assert all(120 <= len(left[i]) <= 120 + 14 for i in (1, 2))
    first = min((r["start"], r["end"]) for r in found.where("doc_id = 0 and kept").collect())
    assert " ".join(left[0]).find(text[0][first[0] : first[1]]) >= 0


def test_buckets_are_taken_in_pairs_or_given_out_whole(spark, monkeypatch):
    monkeypatch.setattr(passages, "_CHUNK", 7)
    rows = [(1, n, 21, 5) for n in range(100)] + [(2, n, 21, 5) for n in range(5)] + [(3, 7, 21, 0), (3, 8, 21, 0x3FF), (4, 9, 21, 0)]
    rows += [(5, n, 21, 0) for n in range(passages.CROWD)] + rows[:50]
    df = spark.createDataFrame(rows, "bucket long, node long, size int, parity long").repartition(3)
    got = passages._meetings(df, 0.8).collect()
    assert sorted((r["bucket"], r["a"]) for r in got if r["bucket"] is not None) == [(1, n) for n in range(100)]
    pairs = sorted((r["a"], r["b"]) for r in got if r["bucket"] is None)
    assert pairs == sorted((a, b) for k in (5, passages.CROWD) for b in range(k) for a in range(b))


def test_neighbours_that_overlap_are_not_compared(spark, monkeypatch):
    rng = random.Random(31)
    word = lambda: "".join(rng.choices("abcdefghij", k=6))
    df = spark.createDataFrame([(i, " ".join(word() for _ in range(1000))) for i in range(60)], "doc_id long, text string")
    seen = []
    monkeypatch.setattr(passages, "_alike", lambda pairs, *a, f=passages._alike: seen.append(pairs.count()) or f(pairs, *a))
    assert passages.repeats(df).count() == 0
    assert sum(seen) < 60 * 1000 / 13 / 2  # a paragraph begins at every 13th word; before, most had their sets compared


def test_neighbours_as_similar_as_the_threshold_need_no_band(spark):
    rng = random.Random(41)
    word = lambda: "".join(rng.choices("abcdefghij", k=6))
    say = lambda n: [word() for _ in range(n)]
    rows = []
    for i in range(0, 60, 2):
        shared = say(150)
        rows += [(i, " ".join([*say(60), *shared])), (i + 1, " ".join([*shared, *say(60)]))]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    found = {(r["doc_id"], r["start"]): r["class_id"] for r in passages.repeats(df, bands=1, rows=12).collect()}
    links = 0
    for i, text in rows:
        words, all_words = words_of([text]), text.split()
        at = passages.anchors(words, passages.LENGTH)
        sets = [{tuple(all_words[k : k + 5]) for k in range(p, p + 21)} for p in at]
        for a, b, x, y in zip(sets, sets[1:], words.start[at].tolist(), words.start[at[1:]].tolist()):
            if len(a & b) >= 0.8 * len(a | b):
                assert found.get((i, x)) == found.get((i, y))
                links += (i, x) in found
    assert links > 10  # before, one band of 12 minima brought few of these together


def test_pairs_of_one_run_are_not_given_out(spark):
    rows = [(1, n, 21, 5, n // 4) for n in range(8)] + [(2, n, 21, 5, 0) for n in range(passages.CROWD + 1)]
    df = spark.createDataFrame(rows, "bucket long, node long, size int, parity long, run long")
    got = passages._meetings(df, 0.8).collect()
    pairs = sorted((r["a"], r["b"]) for r in got if r["bucket"] is None)
    assert pairs == [(a, b) for a in range(4) for b in range(4, 8)]
    assert sorted((r["bucket"], r["a"]) for r in got if r["bucket"] is not None) == [(2, n) for n in range(passages.CROWD + 1)]
