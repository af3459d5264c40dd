"""Words and shingles of many texts at once, as NumPy arrays.

A word is a maximal run of code points other than ``[\\x20\\x09-\\x0D]``; A-Z counts as a-z. Words and
shingles are 64-bit hashes of their code points, so nothing is done word by word in Python.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np

# Code points that are worked on at once. A longer text is a piece of its own.
PIECE = 1_500_000

_BASE = np.uint64(0x9E3779B97F4A7C15)
_MIX_1, _MIX_2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * _MIX_1
    x = (x ^ (x >> np.uint64(27))) * _MIX_2
    return x ^ (x >> np.uint64(31))


@dataclass
class Words:
    """Words of several texts: hash, text number, and where each begins and ends in its text."""

    hash: np.ndarray
    doc: np.ndarray
    start: np.ndarray
    end: np.ndarray
    counts: np.ndarray  # words of each text


def pieces(texts: list[str | None]) -> Iterator[tuple[int, int]]:
    """Ranges of texts with about PIECE code points, one text at least."""
    first, size = 0, 0
    for i, t in enumerate(texts):
        n = len(t or "")
        if size and size + n > PIECE:
            yield first, i
            first, size = i, 0
        size += n
    if first < len(texts):
        yield first, len(texts)


def words_of(texts: list[str | None], is_word: np.ndarray | None = None, lower: np.ndarray | None = None) -> Words:
    """Words of texts; tables by code point may say what belongs to words and what counts as what."""
    texts = [t or "" for t in texts]
    chars = np.frombuffer("\n".join([*texts, ""]).encode("utf-32-le"), "<u4")
    ends_of_docs = np.cumsum([len(t) + 1 for t in texts])
    inside = ~((chars == 32) | ((chars >= 9) & (chars <= 13))) if is_word is None else is_word[chars]
    inside &= chars != 10
    edge = np.diff(inside.astype(np.int8), prepend=0)
    start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    lengths = end - start
    at = np.arange(int(lengths.sum())) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    used = chars[inside]
    if lower is None:
        used = used + 32 * ((used >= 65) & (used <= 90)).astype(np.uint32)
    else:
        used = lower[used]
    if len(lengths):
        powers = np.cumprod(np.full(int(lengths.max()), _BASE))
        sums = np.add.reduceat(mix(used.astype(np.uint64) + np.uint64(1)) * powers[at], np.cumsum(lengths) - lengths)
    else:
        sums = np.zeros(0, np.uint64)
    doc = np.searchsorted(ends_of_docs, start, side="right")
    shift = (ends_of_docs - [len(t) + 1 for t in texts])[doc] if len(doc) else 0
    return Words(mix(sums), doc, start - shift, end - shift, np.bincount(doc, minlength=len(texts)))


def ngrams(words: Words, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of n neighbouring words of a text, and the place of the first of them among all words."""
    total = len(words.hash) - n + 1
    if total <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    out = words.hash[:total].copy()
    for k in range(1, n):
        out = mix(out * _BASE + words.hash[k : k + total])
    at = np.flatnonzero(words.doc[:total] == words.doc[n - 1 :])
    return out[at], at


def shingles(words: Words, n: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all shingles and their texts; a text of fewer words has all of them as its only shingle."""
    grams, at = ngrams(words, n)
    docs = words.doc[at]
    short = np.flatnonzero((words.counts > 0) & (words.counts < n))
    if len(short):
        whole, _ = contents(words)
        grams, docs = np.concatenate([grams, whole[short]]), np.concatenate([docs, short])
    return grams, docs


def contents(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Two independent hashes of each text's sequence of words (0, 0 for a text without any)."""
    out = []
    has = np.flatnonzero(words.counts)
    starts = (np.cumsum(words.counts) - words.counts)[has]
    at = np.arange(len(words.hash)) - np.repeat(starts, words.counts[has])
    for base in (_MIX_1, _MIX_2):
        whole = np.zeros(len(words.counts), np.uint64)
        if len(has):
            powers = np.cumprod(np.full(int(words.counts.max()), base))
            sums = np.add.reduceat(mix(words.hash ^ base) * powers[at], starts)
            whole[has] = mix(sums + words.counts[has].astype(np.uint64))
        out.append(whole)
    return out[0], out[1]
