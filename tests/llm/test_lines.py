from __future__ import annotations

from collections import defaultdict

from pyspark.sql import functions as F

from tidewater.llm import lines


def key(line):
    line = line.strip(" \t\n\x0b\x0c\r")
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in line)


def brute(rows, min_chars=40, min_docs=5):
    holders = defaultdict(set)
    for i, text in rows:
        for line in (text or "").split("\n"):
            if len(key(line)) >= min_chars:
                holders[key(line)].add(i)
    low = lambda i: -1 if i is None else i
    out = []
    for i, text in rows:
        all_lines = (text or "").split("\n")
        kept = [
            x for x in all_lines
            if len(h := holders.get(key(x), ())) < min_docs or low(i) == max(map(low, h))
        ]
        out.append((i, "\n".join(kept), len(all_lines), len(all_lines) - len(kept)))
    return sorted(out, key=repr)


def run(df, **kw):
    rows = lines.dedup_table(df, **kw).select("doc_id", "text", "line_stats.n_lines", "line_stats.n_dropped").collect()
    return sorted(map(tuple, rows), key=repr)


def test_odd_rows(odd_docs, no_docs):
    got = lines.dedup_table(odd_docs)
    assert got.columns == [*odd_docs.columns, "line_stats"]
    assert run(odd_docs) == brute([(r["doc_id"], r["text"]) for r in odd_docs.collect()])
    assert lines.dedup_table(no_docs).count() == 0


def test_many_lines_in_other_cases(spark):
    long = ["Ä line " + "x" * 40 + str(k) for k in range(6)]
    rows = [(i, "\n".join([long[(i + k) % 6].swapcase() if k % 2 else long[k % 6] + " \t" for k in range(i % 9)])) for i in range(60)]
    rows += [(None, long[0]), (7, long[1] + "\n" + long[1]), (7, "short")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert run(df) == brute(rows)
    assert run(df, min_chars=3, min_docs=2, batches=3) == brute(rows, 3, 2)


def test_levels_merge_and_counts_stay(spark):
    runs = lines.LineRuns(spark, fanout=2, buckets=3)
    for batch in range(5):
        rows = [(10 * batch + i, "common " + "y" * 40 + f"\nown {batch} {i} " + "z" * 40) for i in range(4)]
        runs.add(lines.long_keys(spark.createDataFrame(rows, "doc_id long, text string")))
    assert [len(x) for x in runs.levels] == [1, 0, 1]
    known = runs.known(1)
    assert known.count() == 21
    assert [tuple(r) for r in known.where("n_docs > 1").select("n_docs", "max_doc").collect()] == [(20, 43)]
    assert runs.compact() in {t for level in runs.levels for t in level}
    runs.close()


def test_batches_against_earlier_ones(spark):
    runs = lines.LineRuns(spark, buckets=2)
    a, b = "first " + "a" * 40, "second " + "b" * 40
    day = lambda rows: spark.createDataFrame(rows, "doc_id long, text string")
    one = lines.dedup_batch(runs, day([(5, f"{a}\nx")]))
    two = lines.dedup_batch(runs, day([(1, f"{a}\n{b}"), (2, a)]))
    three = lines.dedup_batch(runs, day([(9, f"{b}\ny")]))
    texts = [[r["text"] for r in d.orderBy("doc_id").collect()] for d in (one, two, three)]
    assert texts == [[f"{a}\nx"], [b, ""], ["y"]]
    runs.close()


def test_no_python_in_the_plan(spark, odd_docs):
    plan = lines.dedup_table(odd_docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and F is not None
