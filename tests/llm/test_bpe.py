from __future__ import annotations

import random
import tracemalloc

from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidewater.llm import bpe

PIECES = [
    "a", "aa", "aaa", "the", " ", "  ", "\n", "\t", "\xa0", "\x1c", "\x85", "é", "日本", "1", "²", "\ua7ce", "\U0003d000",
    "!", "'s", "'ll", "<|endoftext|>", "<|endof", "\0", "😀", "\u0301", "\ufffd", "ing", "XYZ", "\u3000", "ſ",
]


def test_as_the_library(vocabulary):
    random.seed(1)
    texts = ["".join(random.choices(PIECES, k=random.randint(0, 30))) for _ in range(5000)]
    texts += ["a" * 5000, "ab" * 3000, "", "\0<|endoftext|>"]
    own, library = bpe.ByteBPE(vocabulary), Tokenizer.from_file(vocabulary)
    flat, counts = own.encode(texts)
    at = 0
    for text, n, want in zip(texts, counts, library.encode_batch(texts, add_special_tokens=False)):
        assert flat[at : at + n].tolist() == want.ids, repr(text)
        at += n
    assert own.decode(flat, counts) == texts


def test_decodes_as_the_library_what_is_no_utf8(vocabulary):
    library, own = Tokenizer.from_file(vocabulary), bpe.ByteBPE(vocabulary)
    random.seed(2)
    import numpy as np

    for _ in range(300):
        ids = [random.choice([*range(90, 256), 50256, 262]) for _ in range(random.randint(1, 6))]
        assert own.decode(np.array(ids), np.array([len(ids)])) == [library.decode(ids, skip_special_tokens=False)]


def test_words_and_bytes_are_held_for_a_part_of_a_batch(vocabulary):
    random.seed(3)
    word = lambda: "".join(random.choices("abcdefghijklmnopqrstuvwxyz", k=7))
    texts = [" ".join(word() for _ in range(2000)) for _ in range(300)] + [None, ""]
    own, library = bpe.ByteBPE(vocabulary), Tokenizer.from_file(vocabulary)
    size = sum(len(t or "") for t in texts)
    tracemalloc.start()
    flat, counts = own.encode(texts)
    encoding = tracemalloc.get_traced_memory()[1] - tracemalloc.get_traced_memory()[0]
    tracemalloc.reset_peak()
    before = tracemalloc.get_traced_memory()[0]
    back = own.decode(flat, counts)
    decoding = tracemalloc.get_traced_memory()[1] - before
    tracemalloc.stop()
    assert encoding < 30 * size and decoding < 12 * size, (encoding / size, decoding / size)
    assert back == [t or "" for t in texts]
    few = texts[:5]
    want = [i for e in library.encode_batch(few, add_special_tokens=False) for i in e.ids]
    assert flat[: counts[:5].sum()].tolist() == want


def test_forgets_and_goes_on(vocabulary, monkeypatch):
    monkeypatch.setattr(bpe, "KEPT_WORDS", 3)
    own = bpe.ByteBPE(vocabulary)
    for text in ("one two three four five", "six seven", "one <|endoftext|> two"):
        ids, counts = own.encode([text])
        assert own.decode(ids, counts) == [text]


def test_odd_rows(odd_docs, no_docs, vocabulary):
    ids = odd_docs.select("doc_id", "text", bpe.encode(F.col("text"), vocabulary).alias("ids"))
    back = ids.select("*", bpe.decode(F.col("ids"), vocabulary).alias("back")).collect()
    assert len(back) == odd_docs.count()
    assert all(r["back"] == r["text"] for r in back)
    assert {r["ids"] is None for r in back if r["text"] is None} == {True}
    assert no_docs.select(bpe.encode(F.col("text"), vocabulary)).count() == 0


def test_ids_and_their_text_by_one_worker(odd_docs, vocabulary):
    one = odd_docs.select("text", bpe.encode(F.col("text"), vocabulary).alias("ids"), bpe.coded(F.col("text"), vocabulary).alias("coded"))
    for r in one.collect():
        assert r["coded"]["ids"] == r["ids"] and r["coded"]["decoded"] == r["text"]
