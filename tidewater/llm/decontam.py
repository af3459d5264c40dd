"""Benchmark decontamination: rare n-gram seeds, then Smith-Waterman alignment.

Words are runs of letters and digits in lower case. A passage that aligns with a test item at the threshold t
holds at least t of the item's words, whatever is replaced, left out or put in between, and is
at most (3 - 2 t) times as long. So of the item's rarest words, enough to be more than 1 - t of
all its words, some must stand there close together: they are the item's seeds (n-grams of one word; of longer ones
none need be left at the threshold, as in an item of which every third word is replaced). How rare a word is
is counted over all documents first. A document meets an item where a window of that length holds the seeds
it must hold at least; that stretch is aligned with the item if a bound on the score, by the item's words
in it, reaches the threshold. The
alignment's score over the best possible one says how much of the item stands there. No pair of a document and an item with a
score of the threshold or more is missed.

Items are the stated query set. They are taken in blocks of ``block`` items, so that what
every task gets is bounded whatever their number: the block's seeds, joined with the words of a batch of documents by
binary search. Each block reads the documents twice (for the counts, for the search) and shuffles nothing but
counts of the block's own words. Documents are independent of each other: a hot source or repeated rows cause no group
anywhere, and what is found in a document does not depend on others, which change only the order of the seeds.

Null and empty texts on either side meet nothing. Items of fewer than ``n`` words must stand in the document as they are. Repeated items and repeated documents give a row each; null ids are kept
as null. Extra columns are not read. Without items or documents there are no rows.
"""

from __future__ import annotations

import functools
import itertools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.llm.arrow import ranges
from tidewater.llm.words import Words, pieces, words_of

NGRAM = 3
THRESHOLD = 0.5
BLOCK = 5_000
# Pairs of a word and an item that are looked at at once.
HITS = 4_000_000

MATCH, MISMATCH, GAP = 2, 1, 1


@functools.cache
def _tables() -> tuple[np.ndarray, np.ndarray]:
    """Per code point: whether it is a letter or digit, and its lower-case form.

    Every Python worker makes its own, so it is done character by character: lists of a million strings would take 200 MB.
    """
    size = 0x110000
    return (
        np.fromiter((chr(c).isalnum() for c in range(size)), bool, size),
        np.fromiter((ord(x) if len(x := chr(c).lower()) == 1 else c for c in range(size)), np.uint32, size),
    )


def plain_words(texts: list[str | None]) -> Words:
    return words_of(texts, *_tables())


@dataclass(frozen=True)
class Seeds:
    """A block of items: their words, and the seed words of all items, sorted by word and item."""

    ids: list
    words: list[np.ndarray]
    distinct: list[tuple[np.ndarray, np.ndarray]]  # each item's distinct words, sorted, and how often they occur
    keys: np.ndarray  # the distinct seed words, sorted
    first: np.ndarray  # where the items of a key begin
    item: np.ndarray  # the items of each key, one after another
    need: np.ndarray  # seeds that a stretch must hold, for each item
    span: np.ndarray  # words that a stretch can have
    bar: np.ndarray  # the score that is asked for


def items_of(rows: list[tuple]) -> tuple[list, list[np.ndarray]]:
    """Ids and words of items."""
    words = plain_words([text for _, text in rows])
    ends = np.cumsum(words.counts)
    return [i for i, _ in rows], [words.hash[e - c : e] for e, c in zip(ends, words.counts)]


def seeds_of(ids: list, words: list[np.ndarray], counts: dict[int, int], n: int, threshold: float) -> Seeds:
    """The rarest words of each item by their counts in the documents; all places of a word count together."""
    keys, items, distinct = [], [], []
    need, span, bar = np.zeros(len(words), np.int64), np.ones(len(words), np.int64), np.ones(len(words))
    for i, w in enumerate(words):
        own, times = np.unique(w, return_counts=True)
        distinct.append((own, times))
        if not len(w):
            continue
        bar[i] = threshold if len(w) >= n else 1.0
        lost = int((1 - bar[i]) * len(w) + 1e-9)
        order = np.lexsort((own, [counts.get(int(x), 0) for x in own]))
        # Some more than must be there, so that one rare word alone is no candidate.
        wanted = min(len(w), lost + 1 + int(bar[i] * len(w) / 4))
        taken = order[: int(np.searchsorted(np.cumsum(times[order]), wanted)) + 1]
        keys.append(own[taken])
        items.append(np.full(len(taken), i))
        need[i] = times[taken].sum() - lost
        span[i] = int((3 - 2 * bar[i]) * len(w) + 1e-9)
    if not keys:
        none = np.zeros(0, np.uint64), np.zeros(1, np.int64), np.zeros(0, np.int64)
        return Seeds(ids, words, distinct, *none, need, span, bar)
    keys, items = np.concatenate(keys), np.concatenate(items)
    order = np.lexsort((items, keys))
    keys, items = keys[order], items[order]
    keys, first = np.unique(keys, return_index=True)
    return Seeds(ids, words, distinct, keys, np.r_[first, len(items)], items, need, span, bar)


def align(item: np.ndarray, passage: np.ndarray) -> tuple[float, int]:
    """Best local alignment's score as a share of a perfect one, and where in the passage it ends."""
    steps = np.arange(len(passage) + 1) * GAP
    row = np.zeros(len(passage) + 1, np.int64)
    best, end = 0, 0
    for word in item:
        new = np.zeros_like(row)
        new[1:] = row[:-1] + np.where(passage == word, MATCH, -MISMATCH)
        new = np.maximum(np.maximum(new, row - GAP), 0)
        row = np.maximum.accumulate(new + steps) - steps  # gaps within the row
        at = int(row.argmax())
        if row[at] > best:
            best, end = int(row[at]), at
    return best / (MATCH * len(item)), end


def _hits(words: Words, seeds: Seeds) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places of seed words among all words, and the items they are seeds of; HITS at once or those of one item."""
    found = np.minimum(np.searchsorted(seeds.keys, words.hash), len(seeds.keys) - 1)
    place = np.flatnonzero(seeds.keys[found] == words.hash)
    key, n = found[place], len(seeds.words)
    every = int((seeds.first[key + 1] - seeds.first[key]).sum())
    parts = min(n, -(-every // HITS))
    keyed = np.repeat(np.arange(len(seeds.keys)), np.diff(seeds.first)) * n + seeds.item
    for p in range(parts):
        low, high = p * n // parts, (p + 1) * n // parts
        start = np.searchsorted(keyed, np.arange(len(seeds.keys)) * n + low)
        count = np.searchsorted(keyed, np.arange(len(seeds.keys)) * n + high) - start
        yield np.repeat(place, count[key]), seeds.item[ranges(start[key], count[key])]


def _stretches(words: Words, seeds: Seeds) -> Iterator[tuple[int, int, list[tuple[int, int]]]]:
    """(text, item, ranges of words) wherever a window of the item's span holds as many seeds as it must."""
    n = len(seeds.words)
    for place, item in _hits(words, seeds):
        group = words.doc[place].astype(np.int64) * n + item
        order = np.argsort(group, kind="stable")  # places rise within a group
        group, place, item = group[order], place[order], item[order]
        last = np.arange(len(group)) + seeds.need[item] - 1
        inside = np.minimum(last, len(group) - 1)
        close = (last < len(group)) & (group[inside] == group) & (place[inside] - place < seeds.span[item])
        at = np.flatnonzero(close)
        low = place[inside[at]] - seeds.span[item[at]] + 1
        high = place[at] + seeds.span[item[at]]
        for g, rows in itertools.groupby(zip(group[at].tolist(), low.tolist(), high.tolist()), key=lambda r: r[0]):
            parts: list[tuple[int, int]] = []
            for _, a, b in rows:
                if parts and a <= parts[-1][1]:
                    parts[-1] = parts[-1][0], b
                else:
                    parts.append((a, b))
            yield *divmod(g, n), parts


def promising(own: np.ndarray, times: np.ndarray, passage: np.ndarray, least: float) -> list[tuple[int, int]]:
    """The stretches of a passage outside of which no alignment reaches the score ``least``.

    ``own`` are the item's distinct words, sorted, ``times`` how often each occurs. An alignment begins with a match and no
    beginning of it scores below 0. Each of its passage's words adds a match at most if it is one of the item's, else it takes off
    at least a gap: where that sum, begun anew when it falls to 0, reaches ``least``, and enough of the
    item's words stand, an alignment may.
    """
    found = np.minimum(np.searchsorted(own, passage), len(own) - 1)
    member = own[found] == passage
    sums = np.cumsum(np.where(member, MATCH, -min(MISMATCH, GAP)))
    running = sums - np.minimum(np.minimum.accumulate(sums), 0)
    out = []
    high = np.flatnonzero(running >= least)
    while len(high):
        at = high[0]
        zeros = np.flatnonzero(running[:at] <= 0)
        start = int(zeros[-1]) + 1 if len(zeros) else 0
        zeros = np.flatnonzero(running[at:] <= 0)
        end = int(at + zeros[0]) if len(zeros) else len(passage)
        inside = found[start:end][member[start:end]]
        if MATCH * np.minimum(np.bincount(inside, minlength=len(own)), times).sum() >= least:
            out.append((start, end))
        high = high[high >= end]
    return out


def found_in(words: Words, seeds: Seeds) -> Iterator[tuple[int, int, float, int, int]]:
    """(text, item, score, start, end) of the best passage for each text and item that meet."""
    if not len(seeds.keys) or not len(words.hash):
        return
    ends = np.cumsum(words.counts)
    for d, i, parts in _stretches(words, seeds):
        item, low, high = seeds.words[i], int(ends[d] - words.counts[d]), int(ends[d])
        (own, times), best, least = seeds.distinct[i], (0.0, 0, 0), float(seeds.bar[i]) - 1e-12
        for a, b in parts:
            a, b = max(a, low), min(b, high)
            for s, e in promising(own, times, words.hash[a:b], least * MATCH * len(item)):
                score, end = align(item, words.hash[a + s : a + e])
                best = max(best, (score, a + s, a + s + end))
        if best[0] >= least:
            score, a, end = best
            _, back = align(item[::-1], words.hash[a:end][::-1])
            yield d, i, score, int(words.start[end - back]), int(words.end[end - 1])


def word_counts(docs: DataFrame, vocabulary: np.ndarray) -> dict[int, int]:
    """How often the words of a bounded vocabulary (sorted hashes) stand in the texts of all documents."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(vocabulary), np.int64)
        for batch in batches:
            texts = batch.column(0).to_pylist()
            for a, b in pieces(texts):
                hashes = plain_words(texts[a:b]).hash
                found = np.minimum(np.searchsorted(vocabulary, hashes), len(vocabulary) - 1)
                total += np.bincount(found[vocabulary[found] == hashes], minlength=len(vocabulary))
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], ["word", "n"])

    sums = docs.select("text").mapInArrow(task, "word long, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return {int(vocabulary[r["word"]]): r["n"] for r in sums.collect()}  # as many rows as words


def seed_blocks(docs: DataFrame, items: DataFrame, n: int, threshold: float, block: int) -> Iterator[Seeds]:
    """The seeds of the items (item_id, text), ``block`` items at a time."""
    rows = items.select(F.col("item_id").cast("long"), "text").toLocalIterator()
    while taken := [tuple(r) for r in itertools.islice(rows, block)]:
        ids, words = items_of(taken)
        if any(map(len, words)):
            counts = word_counts(docs, np.unique(np.concatenate(words)))
            yield seeds_of(ids, words, counts, n, threshold)


def _searched(docs: DataFrame, seeds: Seeds) -> DataFrame:
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            rows = []
            for a, b in pieces(texts):
                for d, i, *rest in found_in(plain_words(texts[a:b]), seeds):
                    rows.append((ids[a + d], seeds.ids[i], *rest))
            kinds = [pa.int64(), pa.int64(), pa.float64(), pa.int32(), pa.int32()]
            columns = zip(*rows) if rows else [[]] * 5
            names = ["doc_id", "item_id", "score", "start", "end"]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

    return docs.mapInArrow(task, "doc_id long, item_id long, score double, start int, end int")


def contaminated(
    docs: DataFrame, items: DataFrame, n: int = NGRAM, threshold: float = THRESHOLD, block: int = BLOCK
) -> DataFrame:
    """(doc_id, item_id, score, start, end) for each document (doc_id, text) that holds a test item (item_id, text).

    ``start`` and ``end`` are the code points of the best passage.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    out = docs.sparkSession.createDataFrame([], "doc_id long, item_id long, score double, start int, end int")
    for seeds in seed_blocks(docs, items, n, threshold, block):
        out = out.unionByName(_searched(docs, seeds))
    return out


def holds(text: Column, seeds: Seeds) -> Column:
    """Whether a text holds one of a block's items."""

    def any_item(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in batches:
            texts = column.to_pylist()
            out = np.zeros(len(texts), bool)
            for a, b in pieces(texts):
                for d, *_ in found_in(plain_words(texts[a:b]), seeds):
                    out[a + d] = True
            yield pa.array(out)

    any_item.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return F.arrow_udf(any_item, "boolean")(text)


def clean(
    docs: DataFrame, items: DataFrame, n: int = NGRAM, threshold: float = THRESHOLD, block: int = BLOCK
) -> DataFrame:
    """The rows whose ``text`` holds no test item, with all their columns. Ids are not looked at, so they may be null."""
    out = docs
    for seeds in seed_blocks(docs, items, n, threshold, block):
        out = out.where(~holds(out["text"], seeds))
    return out
