"""Small tables that hold every awkward case once."""

from __future__ import annotations

import public_tokenizers
import pytest


@pytest.fixture(scope="session")
def vocabulary():
    return public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Null and empty texts, a very long one, repeated rows, extra columns with names the operators use."""
    line = "This line of more than forty characters stands in many documents."
    rows = [
        (0, None), (1, ""), (2, "   \n\t"), (3, "a b c"), (4, "word " * 40_000), (None, "text of nobody " * 30),
        (6, "same row " * 20), (6, "same row " * 20), (7, "x" * 300_000), (8, "end\n"), (9, "\n\n"),
        *[(20 + i, f"head {i}\n  {line.upper() if i % 2 else line}\ntail {i}") for i in range(6)],
    ]
    rows = [(i, t, "en", "src0", len(t or ""), 1, [2], "k") for i, t in rows]
    names = "doc_id long, text string, lang string, source string, n_chars long, gone int, lines array<int>, ids string"
    return spark.createDataFrame(rows, names)


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.where("false")
