from __future__ import annotations

import random
import tracemalloc

import numpy as np

from tidewater.llm import decontam


def smith_waterman(a, b):
    best, row = 0, [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(max(0, row[j] + (2 if x == y else -1), row[j + 1] - 1, new[j] - 1))
        best, row = max(best, *new), new
    return best / (2 * len(a))


def test_alignment():
    rng = np.random.default_rng(2)
    for _ in range(200):
        a, b = rng.integers(0, 5, rng.integers(1, 12)), rng.integers(0, 5, rng.integers(0, 25))
        assert abs(decontam.align(a, b)[0] - smith_waterman(a.tolist(), b.tolist())) < 1e-9


def test_tables_of_characters_take_little_memory_to_make():
    tracemalloc.start()
    letters, lower = decontam._tables.__wrapped__()
    _, most = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert most < 32 << 20
    points = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    assert letters[points].tolist() == [chr(c).isalnum() for c in points]
    assert lower[points].tolist() == [ord(x) if len(x := chr(c).lower()) == 1 else c for c in points]


def corpus():
    rng = random.Random(3)
    word = lambda: "".join(rng.choices("abcdefgh", k=rng.randint(1, 6)))
    items = [(i, " ".join(word() for _ in range(rng.randint(15, 50)))) for i in range(12)]
    docs, want = [], set()
    for i in range(60):
        own = [word() for _ in range(rng.randint(0, 200))]
        if i % 4 == 0:
            item, text = rng.choice(items)
            said = text.split()
            for k in range(len(said)):
                r = rng.random() if i % 8 else 1
                said[k] = "" if r < 0.03 else word() if r < 0.1 else said[k] + "," if r < 0.3 else said[k].upper() if r < 0.4 else said[k]
            at = rng.randint(0, len(own))
            own[at:at] = said
            want.add((i, item))
        docs.append((i, " \n".join(own)))
    return docs, items, want


def test_copies_and_edited_copies_are_found(spark):
    docs, items, want = corpus()
    d = spark.createDataFrame(docs, "doc_id long, text string")
    b = spark.createDataFrame(items, "item_id long, text string")
    rows = decontam.contaminated(d, b).collect()
    assert {(r["doc_id"], r["item_id"]) for r in rows} == want
    text = dict(docs)
    for r in rows:
        item = decontam.plain_words([dict(items)[r["item_id"]]]).hash
        passage = decontam.plain_words([text[r["doc_id"]][r["start"] : r["end"]]]).hash
        assert abs(smith_waterman(item.tolist(), passage.tolist()) - r["score"]) < 1e-9
    blocks = decontam.contaminated(d, b, block=5).collect()
    assert sorted(map(tuple, blocks)) == sorted(map(tuple, rows))


def test_odd_rows(spark, odd_docs, no_docs):
    items = spark.createDataFrame([(1, None), (2, ""), (3, "a b"), (None, "a b c"), (5, "word " * 30), (3, "a b")], "item_id long, text string")
    got = sorted(((r["doc_id"], r["item_id"]) for r in decontam.contaminated(odd_docs, items).collect()), key=repr)
    assert got == sorted([(3, 3), (3, 3), (3, None), (4, 5)], key=repr)
    assert decontam.contaminated(no_docs, items).count() == 0
    assert decontam.contaminated(odd_docs, items.where("false")).count() == 0


def test_equal_edited_copies_beside_an_exact_one(spark):
    rng = random.Random(5)
    word = lambda: "".join(rng.choices("abcdefgh", k=6))
    item = [word() for _ in range(40)]
    for step in (10, 5):  # 10 and 20 % of the words replaced, in all copies alike
        edited = [word() if k % step == step // 2 else w for k, w in enumerate(item)]
        docs = [(i, " ".join([word(), word(), *(edited if i else item), word()])) for i in range(300)]
        d = spark.createDataFrame(docs, "doc_id long, text string").coalesce(2)
        rows = decontam.contaminated(d, spark.createDataFrame([(1, " ".join(item))], "item_id long, text string")).collect()
        assert {r["doc_id"] for r in rows} == set(range(300))
        assert {round(r["score"], 9) for r in rows} == {1.0, round(smith_waterman(item, edited), 9)}


def seeds(items, docs=(), threshold=0.5):
    """The seeds of items (lists of words), with the words counted in the documents."""
    ids, words = decontam.items_of([(i, " ".join(w)) for i, w in enumerate(items)])
    said, n = np.unique(decontam.plain_words([" ".join(d) for d in docs]).hash, return_counts=True)
    return decontam.seeds_of(ids, words, dict(zip(said.tolist(), n.tolist())), 3, threshold)


def found(docs, items, threshold=0.5):
    rows = decontam.found_in(decontam.plain_words([" ".join(w) for w in docs]), seeds(items, docs, threshold))
    return {(d, i): score for d, i, score, *_ in rows}


def test_no_pair_above_the_threshold_is_missed():
    """Short texts of few different words, where many alignments come about by chance."""
    rng = random.Random(6)
    items = [[rng.choice("abcdefghij") for _ in range(rng.randint(3, 9))] for _ in range(25)]
    docs = [[rng.choice("abcdefghijklmnop") for _ in range(rng.randint(0, 25))] for _ in range(120)]
    for threshold in (0.5, 0.6, 0.8):
        best = {(d, i): smith_waterman(y, x) for d, x in enumerate(docs) for i, y in enumerate(items)}
        want = {k for k, s in best.items() if s >= threshold - 1e-12}
        got = found(docs, items, threshold)
        assert set(got) == want and len(want) > (20 if threshold == 0.5 else 0)
        assert all(abs(s - best[k]) < 1e-9 for k, s in got.items())


def edited(rng, item, share, word):
    """A copy with so many of its words replaced, left out, or with one put after them, in even distances."""
    out, debt = [], rng.random()
    for w in item:
        debt += share
        if debt >= 1:
            debt -= 1
            out += rng.choice([[word()], [word()], [], [w, word()]])
        else:
            out.append(w)
    return out


def test_edited_copies_as_all_pairs_say():
    """Items in common and rare words; copies with 10, 20 and 30 % of the words edited within other text."""
    rng = random.Random(8)
    vocabulary = ["".join(rng.choices("abcdefgh", k=rng.randint(2, 6))) for _ in range(400)]
    word = lambda: vocabulary[min(int(rng.paretovariate(0.7)) - 1, 399)]
    items = [[word() for _ in range(rng.randint(15, 45))] for _ in range(30)]
    docs = []
    for k in range(240):
        own = [word() for _ in range(rng.randint(5, 150))]
        if k % 4:
            at = rng.randint(0, len(own))
            own[at:at] = edited(rng, rng.choice(items), (k % 4) / 10, word)
        docs.append(own)
    best = {(d, i): smith_waterman(y, x) for d, x in enumerate(docs) for i, y in enumerate(items)}
    want = {k for k, s in best.items() if s >= 0.5}
    assert set(found(docs, items)) == want and len(want) >= 170


def test_every_third_word_replaced():
    """A score of just above the threshold, without a pair of words that is left in order but one."""
    rng = random.Random(9)
    word = lambda: "".join(rng.choices("abcdefghij", k=8))
    item = [word() for _ in range(31)]
    doc = [*(word() for _ in range(40)), *(word() if k % 3 == 2 else w for k, w in enumerate(item)), *(word() for _ in range(40))]
    got = found([doc], [item])
    assert list(got) == [(0, 0)] and abs(got[0, 0] - smith_waterman(item, doc)) < 1e-9 and got[0, 0] < 0.55


def test_common_words_cost_no_more(monkeypatch):
    """Thousands of common words against a thousand items of which they are a third: seeds are what is rare.

    Only items that are common words for half or more could reach the threshold, and are aligned."""
    rng = random.Random(10)
    common = ["the", "of", "and", "to", "in", "a", "is", "that", "for", "it", "one", "as"]
    rare = lambda: "".join(rng.choices("abcdefghij", k=9))
    items = [[rng.choice(common) if rng.random() < 0.33 else rare() for _ in range(30)] for _ in range(1000)]
    docs = [[rng.choice(common) for _ in range(8000)], [*items[3], *(rng.choice(common) for _ in range(100))]]
    calls = []
    monkeypatch.setattr(decontam, "align", lambda *a, f=decontam.align: calls.append(1) or f(*a))
    half = sum(sum(w in common for w in item) >= 15 for item in items)
    assert (1, 3) in found(docs, items) and half < 100 and len(calls) <= len(docs) * half + 5


def test_hits_in_parts_give_the_same(monkeypatch):
    rng = random.Random(12)
    items = [[rng.choice("abcdefgh") for _ in range(10)] for _ in range(20)]
    docs = [[rng.choice("abcdefgh") for _ in range(60)] for _ in range(10)]
    want = found(docs, items)
    monkeypatch.setattr(decontam, "HITS", 50)
    assert found(docs, items) == want and want


def test_clean_rows_keep_all_columns(spark, odd_docs, no_docs):
    """A null doc_id does not save a document that holds an item."""
    items = spark.createDataFrame([(1, "text of nobody " * 10), (2, None)], "item_id long, text string")
    rows = odd_docs.withColumn("a.b", odd_docs["lang"])
    kept = decontam.clean(rows, items)
    assert kept.columns == rows.columns
    assert sorted(map(repr, kept.collect())) == sorted(repr(r) for r in rows.collect() if r["doc_id"] is not None)
    assert decontam.clean(no_docs, items).count() == 0 and decontam.clean(odd_docs, items.where("false")).count() == odd_docs.count()
