from __future__ import annotations

import random

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
import tiktoken
from pyspark.errors import PythonException
from pyspark.sql import functions as F

from tidewater.llm import bytepiece

PIECES = [
    "a", "aa", "aaa", "the", " ", "  ", "\n", "\t", "\xa0", "\x1c", "\x85", "é", "日本", "1", "²", "꟎", "\U0003d000",
    "!", "'s", "'ll", "<|endoftext|>", "<unk>", "</s>", "\0", "😀", "́", "�", "ing", "XYZ", "　", "ſ", "▁", " ▁",
    "Привет", "мир", "안녕", "⁇",
]


@pytest.fixture(scope="module")
def ranks_path():
    return public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def library(ranks_path):
    ranks = bytepiece.read_ranks(ranks_path)
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def check(own, library, texts):
    flat, counts = own.encode(texts)
    at = 0
    for text, n in zip(texts, counts):
        assert flat[at : at + n].tolist() == library.encode_ordinary(text), repr(text)
        at += n
    assert own.decode(flat, counts) == [t.encode() for t in texts]


def test_as_the_library(ranks_path, library):
    random.seed(1)
    texts = ["".join(random.choices(PIECES, k=random.randint(0, 30))) for _ in range(5000)]
    texts += ["a" * 5000, "ab" * 3000, "", "x" * 200_000 + " y"]
    check(bytepiece.byte_pieces(ranks_path), library, texts)


def test_every_code_point(ranks_path, library):
    points = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    check(bytepiece.byte_pieces(ranks_path), library, ["a".join(points[i : i + 500]) for i in range(0, len(points), 500)])


def test_a_word_that_is_a_token_needs_no_merges():
    """b'xyz' is a token that no two tokens make; tiktoken finds it as a whole word only."""
    ranks = {bytes([b]): b for b in range(256)} | {b"xyz": 256, b"ab": 257, b"bc": 258, b"abc": 260}
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    own = bytepiece.BytePieces(ranks)
    check(own, library, ["xyz", "xyzz", "abc", "abcabc", "abab bcbc"])
    assert own.encode(["xyz abc"])[0].tolist() == [256, 32, 260]
    with pytest.raises(ValueError, match="no tokens for the bytes"):
        bytepiece.model({b"a": 0})


def test_model_is_one_that_sentencepiece_reads(ranks_path):
    ranks = bytepiece.read_ranks(ranks_path)
    model = sentencepiece.SentencePieceProcessor(model_proto=bytepiece.model(ranks))
    assert model.get_piece_size() == len(ranks) + 1 and model.unk_id() == len(ranks)
    for token in random.Random(3).sample(sorted(ranks), 500):
        assert bytepiece.as_bytes(model.id_to_piece(ranks[token])) == token
        assert model.get_score(ranks[token]) == -ranks[token]


def test_forgets_and_goes_on(ranks_path, library, monkeypatch):
    monkeypatch.setattr(bytepiece, "KEPT_WORDS", 3)
    own = bytepiece.BytePieces(bytepiece.read_ranks(ranks_path))
    for text in ("one two three four five", "six seven", "one two"):
        check(own, library, [text])


def test_bytes_that_are_no_utf8(ranks_path):
    own = bytepiece.byte_pieces(ranks_path)
    random.seed(2)
    table = {i: t for t, i in bytepiece.read_ranks(ranks_path).items()}
    ids = [[random.randrange(len(table)) for _ in range(random.randint(0, 6))] for _ in range(300)]
    flat = np.array([i for row in ids for i in row])
    assert own.decode(flat, np.array([len(r) for r in ids])) == [b"".join(table[i] for i in r) for r in ids]


def test_odd_rows(odd_docs, no_docs, ranks_path):
    ids = odd_docs.select("doc_id", "text", bytepiece.encode(F.col("text"), ranks_path).alias("ids"))
    back = ids.select("*", bytepiece.decode(F.col("ids"), ranks_path).alias("back")).collect()
    assert len(back) == odd_docs.count()
    assert all((r["back"] is None) == (r["text"] is None) for r in back)
    assert all(bytes(r["back"]).decode() == r["text"] for r in back if r["text"] is not None)
    assert no_docs.select(bytepiece.encode(F.col("text"), ranks_path)).count() == 0


def test_odd_ids(spark, ranks_path):
    rows = spark.createDataFrame([(1, None), (2, []), (3, [65, None]), (4, [0, 1])], "k int, ids array<int>")
    got = {r["k"]: r["b"] for r in rows.select("k", bytepiece.decode(F.col("ids"), ranks_path).alias("b")).collect()}
    assert got[1] is None and got[2] == b"" and got[3] is None and len(got[4]) == 2
    beyond = spark.createDataFrame([([10**6],)], "ids array<int>")
    with pytest.raises(PythonException, match="not in the vocabulary"):
        beyond.select(bytepiece.decode(F.col("ids"), ranks_path)).collect()
