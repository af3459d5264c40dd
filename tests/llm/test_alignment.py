from __future__ import annotations

import bisect
import functools
import hashlib
import itertools
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidewater.llm import alignment

PATHS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
PIECES = [
    "a", "the", " ", "  ", "\n", "\t", "é", "日本", "1", "²", "!", "'ll", "<|endoftext|>", "<s>", "</s>", "<unk>", "<0x41>",
    "\0", "😀", "́", "�", "ing", "XYZ", "　", "unbelievable", "tokenization", "Привет", "▁",
]


@pytest.fixture(scope="module")
def pair():
    return alignment.pair_of(*PATHS)


@functools.cache
def libraries():
    a = Tokenizer.from_file(PATHS[0])
    a.encode_special_tokens = True
    letters = [*range(33, 127), *range(161, 173), *range(174, 256)]
    chars = {chr(b): b for b in letters} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in letters)}
    return a, chars, sentencepiece.SentencePieceProcessor(model_file=PATHS[1])


def library_tokens(text):
    """Ids and bytes of the tokens of both libraries."""
    a_library, chars, b_library = libraries()
    a = a_library.encode(" " + text, add_special_tokens=False).ids
    b = b_library.encode(text)
    a_bytes = [bytes(chars[c] for c in a_library.id_to_token(i)) for i in a]
    b_pieces = [b_library.id_to_piece(i) for i in b]
    b_bytes = [bytes([int(p[3:5], 16)]) if b_library.is_byte(i) else p.replace("▁", " ").encode() for i, p in zip(b, b_pieces)]
    return a, a_bytes, b, b_bytes


def brute(text):
    """(a ids, b ids, groups text, links as id pairs) by the definition, byte by byte."""
    none = [], [], "", []
    if not text:
        return none
    a, a_bytes, b, b_bytes = library_tokens(text)
    if not b"".join(a_bytes) == b"".join(b_bytes) == b" " + text.encode():
        return none
    a_ends, b_ends = (list(itertools.accumulate(map(len, x))) for x in (a_bytes, b_bytes))
    cuts = sorted(set(a_ends) & set(b_ends))
    groups = [([], []) for _ in cuts]
    for side, (ids, ends) in enumerate(((a, a_ends), (b, b_ends))):
        for i, end in zip(ids, ends):
            groups[bisect.bisect_left(cuts, end)][side].append(str(i))
    owners = [[k for k, t in enumerate(x) for _ in t] for x in (a_bytes, b_bytes)]
    links = [(a[i], b[j]) for i, j in dict.fromkeys(zip(*owners))]
    return a, b, ";".join(f"{','.join(x)}|{','.join(y)}" for x, y in groups), links


def brute_rows(texts):
    """The query's columns for each text."""
    found = [brute(t) for t in texts]
    counts = Counter(link for x in found for link in x[3])
    most = {}
    for (_, j), n in counts.items():
        most[j] = max(most.get(j, 0), n)
    out = []
    for a, b, groups, links in found:
        digest = hashlib.sha256(groups.encode()).hexdigest() if groups else ""
        sums = sum(counts[x] == most[x[1]] for x in links), sum(counts[x] for x in links)
        out.append((len(a), len(b), groups.count(";") + bool(groups), len(links), *sums, digest))
    return out


def random_texts(n):
    random.seed(4)
    return ["".join(random.choices(PIECES[: random.choice([27, 28])], k=random.randint(0, 25))) for _ in range(n)]


def test_links_and_groups_by_the_definition(pair):
    texts = [*random_texts(400), None, "", "▁", " ", "word " * 300]
    a, b = pair.encode(texts)
    for lane in (1, 3, 256):
        x = alignment.aligned(pair, a, b, lane)
        ends = np.cumsum(x.n_links)
        for i, (text, groups) in enumerate(zip(texts, alignment.groups_text(pair, x))):
            want_a, want_b, want_groups, want_links = brute(text)
            s, e = ends[i] - x.n_links[i], ends[i]
            assert groups == want_groups
            assert (a.counts[i], b.counts[i]) == (len(want_a), len(want_b))
            assert list(zip(a.ids[x.links_a[s:e]].tolist(), b.ids[x.links_b[s:e]].tolist())) == want_links
            assert x.n_groups[i] == groups.count(";") + bool(groups)


def test_steps_do_not_grow_with_the_longest_text(pair, monkeypatch):
    a, b = pair.encode(["some words of a text " * 20_000, "short"])
    steps = []
    monkeypatch.setattr(alignment.np, "concatenate", lambda x, f=np.concatenate: steps.append(len(x)) or f(x))
    alignment.aligned(pair, a, b)
    assert max(steps) <= 4 * alignment.LANE


def test_packed_columns():
    for n in (0, 1, 5, 1000):
        columns = np.random.default_rng(n).integers(0, 2**32, (2, n))
        assert (alignment.unpack(alignment.pack(*columns), 2) == columns).all()


def scored(docs):
    rows = alignment.align(docs, *PATHS)
    return alignment.scored(rows.withColumn("sha", F.when(F.col("n_groups") > 0, F.sha2("groups", 256)).otherwise("")))


def test_counts_over_blocks(spark, monkeypatch):
    monkeypatch.setattr(alignment, "BLOCK_BYTES", 200)
    texts = [*random_texts(300), *["the same text in many rows, a hot group of copies"] * 200, None, ""]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(7)
    got = {r["doc"]["doc_id"]: tuple(r)[1:5] + (r["n_best"], r["count_sum"], r["sha"]) for r in scored(docs).collect()}
    assert [got[i] for i in range(len(texts))] == brute_rows(texts)


def test_odd_rows(spark, odd_docs, no_docs):
    keyed = odd_docs.withColumn("n_a", F.lit("mine")).withColumn("a.b", F.lit(None).cast("int")).withColumn("block", F.lit(1))
    got = scored(keyed).collect()
    assert len(got) == odd_docs.count()
    by_id = lambda i: [r for r in got if r["doc"]["doc_id"] == i]
    for i in (0, 1):
        assert [tuple(r)[1:5] for r in by_id(i)] == [(0, 0, 0, 0)] and by_id(i)[0]["sha"] == "" and by_id(i)[0]["groups"] == ""
    assert len(by_id(6)) == 2 and by_id(6)[0] == by_id(6)[1] and len(by_id(None)) == 1
    assert {r["doc"]["n_a"] for r in got} == {"mine"} and {r["doc"]["a.b"] for r in got} == {None}
    assert scored(no_docs).collect() == []
