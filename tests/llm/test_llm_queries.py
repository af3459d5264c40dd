"""The registered queries over a small scale: against their SQL, or against brute force."""

from __future__ import annotations

import base64
import hashlib

import duckdb
import numpy as np
import public_tokenizers
import pytest
import tiktoken
from oracle import compare, connect
from tokenizers import Tokenizer

from tidewater.llm import queries


@pytest.fixture(scope="module")
def con(sf):
    return connect(sf)


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_same_rows(spark, con, sf, name):
    assert compare(spark, con, queries.QUERIES[name], queries.SQL[name], sf) is None


def test_op1(spark, con, sf, vocabulary):
    library = Tokenizer.from_file(vocabulary)
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    want = {}
    for i, text in con.execute("select doc_id, coalesce(text, '') from documents").fetchall():
        ids = library.encode(text, add_special_tokens=False).ids
        want[i] = (len(ids), sha(",".join(map(str, ids))), sha(library.decode(ids, skip_special_tokens=False)))
    assert {r[0]: tuple(r[1:]) for r in queries.QUERIES["op1_bpe"](spark, sf).collect()} == want


def test_op11(spark, con, sf):
    from test_alignment import brute_rows

    rows = con.execute("select doc_id, text from documents order by doc_id").fetchall()
    want = {i: x for (i, _), x in zip(rows, brute_rows([t for _, t in rows]))}
    got = {tuple(r)[0]: tuple(r)[1:] for r in queries.QUERIES["op11_align"](spark, sf).collect()}
    assert got == want


def test_op12(spark, con, sf):
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    sha = lambda b: hashlib.sha256(b).hexdigest()
    want = {}
    for i, text in con.execute("select doc_id, coalesce(text, '') from documents").fetchall():
        ids = library.encode_ordinary(text)
        want[i] = (len(ids), sha(",".join(map(str, ids)).encode()), sha(library.decode_bytes(ids)))
    assert {r[0]: tuple(r[1:]) for r in queries.QUERIES["op12_bytepiece"](spark, sf).collect()} == want


def test_op13(spark, con, sf):
    from test_whitening import held_to

    rows = con.execute("select vec_id, embedding from embeddings order by vec_id").fetchall()
    rows = [(i, v) for i, v in rows if v is not None and all(c is not None and np.isfinite(c) for c in v)]
    x = np.floor(256 * np.array([v for _, v in rows], float)).astype(np.int64)
    held_to(queries.QUERIES["op13_whitening"](spark, sf).collect(), x, [i for i, _ in rows])


def test_op2(spark, con, sf):
    from test_secrets import brute

    rows = queries.QUERIES["op2_secrets"](spark, sf).collect()
    text = dict(con.execute("select doc_id, coalesce(text, '') from documents").fetchall())
    assert len(rows) == len(text)
    for r in rows:
        spans = brute(text[r["doc_id"]])
        said = ",".join(f"{k}:{a}:{b}" for k, a, b in spans)
        assert r["base_sha256"] == hashlib.sha256(said.encode()).hexdigest()
        assert (r["n_assign"], r["n_access"], r["n_hex"]) == tuple(sum(k == x for k, *_ in spans) for x in ("assign", "access", "hex"))
        assert [s for s in r["spans"].split(",") if s and not s.startswith("literal")] == [s for s in said.split(",") if s]


def test_op9(spark, con, sf):
    from test_quality import brute

    text = dict(con.execute("select doc_id, text from documents").fetchall())
    labels = {i: q for i, q, _ in con.execute("select * from labels").fetchall()}
    rows = {r["doc_id"]: r for r in queries.QUERIES["op9_quality"](spark, sf).collect()}
    assert set(rows) == set(text)
    for i, r in rows.items():
        stats = brute(text[i])
        assert tuple(r)[1:6] == stats
        assert r["base_failed"] == (stats[0] < 50 or 100 * stats[4] > 50 * stats[0])
        assert r["kept"] is False or not r["base_failed"]
    passed = [i for i in labels if not rows[i]["base_failed"]]
    kept = lambda q: sum(rows[i]["kept"] for i in passed if labels[i] == q) / max(1, sum(labels[i] == q for i in passed))
    assert kept(1) >= 0.98 and kept(0) <= 0.2


def test_op10(spark, con, sf):
    from test_chat import brute

    rows = con.execute("select conv_id, turn, role, text from conversations").fetchall()
    rows += [(-1, 0, "user", queries.CONTROL_TURN), (-1, 1, "assistant", queries.CONTROL_TURN)]
    got = queries.QUERIES["op10_chat"](spark, sf).collect()
    assert sorted((tuple(r)[:5] for r in got), key=repr) == brute(rows)


def test_op6_finds_what_brute_force_finds(spark, con, sf):
    from test_minhash import classes_by_brute_force

    rows = con.execute("select doc_id, text from documents order by 1").fetchall()
    got = {r["doc_id"]: r["class_id"] for r in queries.QUERIES["op6_minhash"](spark, sf).collect()}
    assert got == classes_by_brute_force(rows, 0.8)


def test_op5_finds_the_items_that_stand_in_documents(spark, con, sf):
    got = {(r["doc_id"], r["item_id"]) for r in queries.QUERIES["op5_decontam"](spark, sf).collect()}
    inside = con.execute(
        "select doc_id, item_id from documents d, benchmark b where length(b.text) > 0 and contains(d.text, b.text)"
    ).fetchall()
    assert set(inside) <= got and len(got) <= len(inside) + 5


def test_op3_finds_passages_of_over_50_words(spark, con, sf):
    rows = con.execute("select doc_id, text from documents order by 1").fetchall()
    holders: dict[tuple, set] = {}
    for i, text in rows:
        words = text.split()
        for k in range(len(words) - 51):
            holders.setdefault(tuple(words[k : k + 52]), set()).add(i)
    want = {i for found in holders.values() if len(found) > 1 for i in found}
    got = {r["doc_id"] for r in queries.QUERIES["op3_passages"](spark, sf).collect()}
    assert want <= got and duckdb is not None
