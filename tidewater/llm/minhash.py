"""Near-duplicate documents by ProbMinHash.

A document is a weighted set: its shingles of five words, each with the number of times it
occurs. Every shingle sends points of a Poisson process whose rate is its weight; each point
goes to a random register, and a register keeps the shingle of its earliest point. A shingle
stops as soon as its next point comes later than every register's earliest one. Two documents agree in a
register with the probability Jaccard similarity of their sets, which is plain Jaccard for equal weights.

Registers are cut into bands; documents that agree in a whole band share a bucket. Links
within buckets are verified by the exact similarity (see ``buckets``), and classes are the
components of links. With the standard 24 bands of 6 registers, a pair of similarity 0.8 shares a
bucket with probability 0.9993, one of 0.9 with 0.99999998.

Documents of equal words are one node from the start, so a group of exact copies is one row per
task before it is shuffled. Null texts and texts without words have no copies. A null
doc_id belongs to no class (class_id is null). Rows of equal doc_id are one document; of different texts
under one id the smallest is compared. Extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.llm.arrow import list_of
from tidewater.llm.buckets import likely, link, parity_words
from tidewater.llm.words import contents, mix, pieces, shingles, words_of
from tidewater.llm.staging import staged

SHINGLE = 5
THRESHOLD = 0.8
BANDS, ROWS = 24, 6

_GOLD = np.uint64(0x9E3779B97F4A7C15)
_WRAP = (1 << 64) - 1
_TO_REGISTER = np.uint64(0xD6E8FEB86659FD93)


def weighted(grams: np.ndarray, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingles of each text with their counts, ordered by text and shingle."""
    order = np.lexsort((grams, docs))
    grams, docs = grams[order], docs[order]
    first = np.flatnonzero(np.r_[True, (grams[1:] != grams[:-1]) | (docs[1:] != docs[:-1])][: len(grams)])
    return grams[first], docs[first], np.diff(np.r_[first, len(grams)])


def signatures(items: np.ndarray, docs: np.ndarray, weights: np.ndarray, n_docs: int, registers: int) -> np.ndarray:
    """The item in each register of each document."""
    earliest = np.full(n_docs * registers, np.inf)
    held = np.zeros(n_docs * registers, np.uint64)
    latest = np.full(n_docs, np.inf)
    active, time = np.arange(len(items)), np.zeros(len(items))
    k = 0
    while len(active):
        k += 1
        random = mix(items[active] + np.uint64(k * int(_GOLD) & _WRAP))
        uniform = ((random >> np.uint64(11)).astype(float) + 0.5) * 2.0**-53
        time = time - np.log(uniform) / weights[active]
        early = time < latest[docs[active]]
        active, time, random = active[early], time[early], random[early]
        register = (mix(random ^ _TO_REGISTER) % np.uint64(registers)).astype(np.int64) + docs[active] * registers
        better = np.flatnonzero(time < earliest[register])
        order = better[np.lexsort((time[better], register[better]))]
        won = order[np.r_[True, register[order][1:] != register[order][:-1]][: len(order)]]
        earliest[register[won]], held[register[won]] = time[won], items[active[won]]
        touched = np.unique(docs[active[won]])
        latest[touched] = earliest.reshape(n_docs, registers)[touched].max(1)
    return held.reshape(n_docs, registers)


def bands_of(held: np.ndarray, bands: int) -> np.ndarray:
    """A key per band, different for different bands."""
    rows = held.reshape(len(held), bands, -1)
    out = np.tile(np.arange(1, bands + 1).astype(np.uint64) * _GOLD, (len(held), 1))
    for r in range(rows.shape[2]):
        out = mix(out * _GOLD + rows[:, :, r])
    return out


def sketches(docs: DataFrame, shingle: int, bands: int, rows: int) -> DataFrame:
    """(doc_id, h1, h2, bands): two hashes of the words in order, and the keys of the bands (null without words)."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for a, b in pieces(texts):
                words = words_of(texts[a:b])
                h1, h2 = contents(words)
                items, of, weights = weighted(*shingles(words, shingle))
                keys = bands_of(signatures(items, of, weights, b - a, bands * rows), bands)
                flat = pa.array(keys.view(np.int64).ravel())
                lists = list_of(np.arange(b - a + 1) * bands, flat, words.counts > 0)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), pa.array(h1.view(np.int64)), pa.array(h2.view(np.int64)), lists],
                    ["doc_id", "h1", "h2", "bands"],
                )

    return docs.mapInArrow(task, "doc_id long, h1 long, h2 long, bands array<long>")


def shingle_sets(docs: DataFrame, shingle: int) -> DataFrame:
    """(node, items, weights, parity) of (doc_id, text)."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for a, b in pieces(texts):
                items, of, weights = weighted(*shingles(words_of(texts[a:b]), shingle))
                ends = np.r_[0, np.cumsum(np.bincount(of, minlength=b - a))]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(a, b - a),
                        list_of(ends, pa.array(items.view(np.int64))),
                        list_of(ends, pa.array(weights.astype(np.int32))),
                        parity_words(ends, items),
                    ],
                    ["node", "items", "weights", "parity"],
                )

    return docs.mapInArrow(task, "node long, items array<long>, weights array<int>, parity array<long>")


def near_duplicates(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    shingle: int = SHINGLE,
    threshold: float = THRESHOLD,
    bands: int = BANDS,
    rows: int = ROWS,
) -> DataFrame:
    """(doc_id, class_id) for each row: the smallest doc_id of the document's class."""
    docs = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    sketch = staged(sketches(docs, shingle, bands, rows), "sketches")
    known = sketch.where(F.col("bands").isNotNull() & F.col("doc_id").isNotNull())
    same = known.groupBy("h1", "h2").agg(F.min_by("bands", "doc_id").alias("bands"), F.min("doc_id").alias("node"))
    same = staged(same, "contents")
    members = same.select(F.explode("bands").alias("bucket"), "node")

    def sets_of(nodes: DataFrame) -> DataFrame:
        texts = likely(docs, "doc_id", nodes).join(nodes, F.col("doc_id") == F.col("node")).groupBy("doc_id").agg(F.min("text").alias("text"))
        return shingle_sets(texts, shingle)

    _, labels = link(members, sets_of, threshold)
    named = labels.select(F.col("node").alias("of"), "label")
    classes = same.join(named, F.col("node") == F.col("of"), "left").select(
        F.col("h1").alias("c1"), F.col("h2").alias("c2"), F.coalesce("label", "node").alias("class_id")
    )
    classes = staged(classes, "classes")
    own = F.when(F.col("bands").isNull(), F.col("doc_id")).otherwise(F.col("class_id"))
    found = sketch.join(classes, (F.col("h1") == F.col("c1")) & (F.col("h2") == F.col("c2")), "left")
    return found.select("doc_id", F.when(F.col("doc_id").isNotNull(), own).alias("class_id"))


def one_of_each(docs: DataFrame, classes: DataFrame) -> DataFrame:
    """The documents that stand for their class, one row each; rows with a null doc_id stay."""
    chosen = classes.where("doc_id = class_id").select(F.col("doc_id").alias("chosen")).distinct()
    rows = docs.select(F.col("doc_id").alias("key"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"))
    kept = rows.join(chosen, F.col("key") == F.col("chosen"), "left_semi")
    # Rows of equal doc_id lie together after the join; the one of the smallest text is taken.
    kept = kept.groupBy("key").agg(F.min_by("doc", F.coalesce(F.col("doc")["text"], F.lit(""))).alias("doc"))
    nameless = rows.where(F.col("key").isNull())
    return kept.unionByName(nameless).select("doc.*")
