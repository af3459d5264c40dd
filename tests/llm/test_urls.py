from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewater.llm import urls
from tidewater.llm.queries import RULES


def judged(spark, values, rules, default="allow"):
    df = spark.createDataFrame([(i, u, "x") for i, u in enumerate(values)], "id long, url string, host string")
    name = urls.ship(spark, urls.digest_file(rules), "test-rules")
    parts = df.select("id", urls.host_of(F.col("url")).alias("h"), urls.path_of(F.col("url")).alias("p"))
    rows = parts.select("*", urls.judge(F.col("h"), F.col("p"), name, default).alias("j")).orderBy("id").collect()
    return [(r["h"], r["p"], r["j"]["rule"], r["j"]["verdict"]) for r in rows]


def test_rules(spark):
    got = judged(
        spark,
        [
            "http://A.Example.NET/en/1?x#y", "http://a.example.net/de", "https://xexample.net/en/", "http://net/",
            "http://net", "http://example.com/de/", "http://a.example.com/en/", "ftp://x.org/fr/a", "no scheme", None,
            "", "http://", "http://ÄB.Net/a://b", "http://a.net?q=/en/", "x\ny://b.net/\n",
        ],
        RULES,
    )
    assert got == [
        ("a.example.net", "/en/1", "example.net/en/", "allow"), ("a.example.net", "/de", "net/", "block"),
        ("xexample.net", "/en/", "net/", "block"), ("net", "/", "net/", "block"), ("net", "", None, "allow"),
        ("example.com", "/de/", "example.com/de/", "block"), ("a.example.com", "/en/", None, "allow"),
        ("x.org", "/fr/a", "org/fr/", "allow"), ("", "", None, "allow"), ("", "", None, "allow"), ("", "", None, "allow"),
        ("", "", None, "allow"), ("Äb.net", "/a://b", "net/", "block"), ("a.net", "", None, "allow"),
        ("b.net", "/\n", "net/", "block"),
    ]


def test_equal_hashes_are_told_apart(tmp_path, monkeypatch):
    monkeypatch.setattr(urls.xxhash, "xxh64_intdigest", lambda s: len(s))
    path = tmp_path / "rules"
    path.write_bytes(urls.digest_file([("block", "aa.x", "/"), ("allow", "bb.x", "/"), ("block", "y", "/a")]))
    rules = urls.DigestArray(str(path))
    assert rules.decide(["bb.x", "cc.x", "aa.x", "y"], ["/", "/", "/", "/b"]) == [
        ("bb.x/", "allow"), None, ("aa.x/", "block"), None,
    ]


def test_many_rules_against_brute_force(tmp_path):
    rng = np.random.default_rng(3)
    parts = ["a", "b", "cc", "net", "org"]
    host = lambda: ".".join(rng.choice(parts, rng.integers(1, 4)))
    rules = list({(host(), "/" + "".join(rng.choice(["p", "q", "/"], rng.integers(0, 4)))) for _ in range(400)})
    rules = [("allow" if rng.random() < 0.5 else "block", *r) for r in rules]
    path = tmp_path / "rules"
    path.write_bytes(urls.digest_file(rules))
    hosts = [host() for _ in range(500)]
    paths = ["/" + "".join(rng.choice(["p", "q", "/"], rng.integers(0, 6))) for _ in hosts]
    want = []
    for h, p in zip(hosts, paths):
        fits = [(len(r + q), len(r), a == "block", r + q, a) for a, r, q in rules if (h == r or h.endswith("." + r)) and p.startswith(q)]
        want.append((max(fits)[3], max(fits)[4]) if fits else None)
    assert urls.DigestArray(str(path)).decide(hosts, paths) == want


def test_no_rules_and_wrong_rules(spark):
    assert judged(spark, ["http://a.net/"], [], "block") == [("a.net", "/", None, "block")]
    with pytest.raises(ValueError):
        urls.digest_file([("deny", "a", "/")])
