"""Substring dedup: paragraphs that documents share, by MinHash bands.

Texts need not have paragraph marks, and a copied passage may begin in the middle of a line. So
paragraphs are windows of ``length`` words at content-defined places: of every ``length`` neighbouring
places the one whose next four words have the smallest hash. Two texts that share a passage of
2 * length + 2 words or more, whatever surrounds it, have a paragraph in common; with the
standard 25 words this holds for all passages of over 50 words. Repetitive text has a paragraph at each
place with the smallest hash, so that a passage which repeats itself is covered to its end; those of equal
words are one node.

Neighbouring paragraphs of a text that are as similar as the threshold are linked where they are found: a run.

A paragraph is a set of shingles of five words. Bands of ``rows`` minimum hashes collect paragraphs that may
be alike: with 5 bands of 2 a pair of similarity 0.8 meets with probability 0.994, of 0.9 with 0.9998, and paragraphs
of equal words always meet and are always in one class. Colliding paragraphs of different words are verified by
exact Jaccard similarity, and the classes are components of the verified links; no link within
a band is lost. A word replaced within a paragraph may take it below the threshold (in the middle of 25 words:
0.62); the untouched paragraphs of a longer passage still meet. A class is a repeat when at
least two documents hold it; its first paragraph (smallest doc_id, then place) stays.

Most paragraphs that meet are neighbours of one text, either of one run, which needs no second link, or not alike. So a row carries its run, and a row in a bucket carries
64 parities of its set: every bit in which those of two sets differ is an element that one of them lacks, so more
bits than a similar pair's sets can differ by rule a pair out where it meets. In a bucket of up to CROWD paragraphs all pairs are looked
at in this way; larger ones are not taken in pairs but by ``buckets``. Bands are dealt out one after
another, so that a shuffle holds one row for each paragraph.

Paragraphs that a task has met before are known to be repeated and need no band, so a
passage that a third of the documents share is a few rows per task in the shuffle by bands.

Null, empty and short texts (under ``length`` words) have no paragraphs. Null doc_ids are left out. Rows of
equal doc_id are one document; where their texts differ, places are those of each text. Whole texts are read; offsets are code points.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewater.llm.buckets import labelled, link
from tidewater.llm.components import components
from tidewater.llm.minhash import shingle_sets, weighted
from tidewater.llm.words import Words, mix, ngrams, pieces, shingles, words_of
from tidewater.llm.staging import drop, staged

LENGTH = 25
SHINGLE = 5
ANCHOR = 4
THRESHOLD = 0.8
BANDS, ROWS = 5, 2

_GOLD = 0x9E3779B97F4A7C15
_WRAP = (1 << 64) - 1
_MET = 150_000  # paragraphs that a task remembers at once
_PLAIN = {"parquet.enable.dictionary": "false"}  # hashes hardly repeat
CROWD = 32  # paragraphs of a bucket that are taken in pairs
_CHUNK = 1 << 16  # rows of buckets that are worked on at once


def _sliding(values: np.ndarray, width: int, best) -> np.ndarray:
    """best (minimum or maximum) of each ``width`` neighbours, by doubling."""
    done = 1
    while done < width:
        step = min(done, width - done)
        values = best(values[:-step], values[step:])
        done += step
    return values


def anchors(words: Words, length: int) -> np.ndarray:
    """Places, among all words, at which a paragraph begins."""
    n = len(words.hash)
    ends = np.repeat(np.cumsum(words.counts), words.counts)
    grams, at = ngrams(words, ANCHOR)
    if n >= length + ANCHOR - 1 and len(grams):
        hashes = np.full(n, np.uint64(_WRAP))
        hashes[at] = grams
        least = _sliding(hashes, length, np.minimum)
        # A run of places counts only if all of it, with the last place's words, is in one text.
        inside = np.arange(len(least)) + length + ANCHOR - 1 <= ends[: len(least)]
        least[~inside] = 0
        padded = np.concatenate([np.zeros(length - 1, np.uint64), least, np.zeros(n - len(least), np.uint64)])
        chosen = np.flatnonzero((_sliding(padded, length, np.maximum) == hashes) & (hashes != _WRAP))
        chosen = chosen[chosen + length <= ends[chosen]]
    else:
        chosen = np.zeros(0, np.int64)
    # Texts too short for a run of places have one paragraph, their beginning.
    short = (words.counts >= length) & (words.counts < length + length + ANCHOR - 1)
    starts = (np.cumsum(words.counts) - words.counts)[short]
    return np.union1d(chosen, starts).astype(np.int64)


def parity(own: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """64 parities of each row's set of hashes, and how many hashes it has."""
    own = np.sort(own, 1)
    first = np.ones(own.shape, bool)
    first[:, 1:] = own[:, 1:] != own[:, :-1]
    bits = np.where(first, np.uint64(1) << (mix(own) & np.uint64(63)), np.uint64(0))
    return np.bitwise_xor.reduce(bits, 1), first.sum(1)


def _near(bits: np.ndarray, size: np.ndarray, other_bits: np.ndarray, other_size: np.ndarray, threshold: float) -> np.ndarray:
    """Whether the parities of two sets leave that similarity possible."""
    return np.bitwise_count(bits ^ other_bits) * (1 + threshold) <= (size + other_size) * (1 - threshold) + 1e-6


def runs(own: np.ndarray, bits: np.ndarray, size: np.ndarray, doc: np.ndarray, content: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """For each paragraph the smallest content of its run (neighbours of one text of which each is that similar to the next), and whether it is alone in it."""
    at = np.flatnonzero((doc[1:] == doc[:-1]) & _near(bits[1:], size[1:], bits[:-1], size[:-1], threshold))
    both = np.sort(np.concatenate([own[at], own[at + 1]], 1), 1)
    whole = 1 + (both[:, 1:] != both[:, :-1]).sum(1)
    other = np.ones(len(own), bool)
    other[1 + at[size[at] + size[at + 1] - whole >= (threshold - 1e-9) * whole]] = False
    starts = np.flatnonzero(other)
    if not len(starts):
        return content.view(np.int64), other
    counts = np.diff(np.r_[starts, len(own)])
    return np.repeat(np.minimum.reduceat(content.view(np.int64), starts), counts), np.repeat(counts == 1, counts)


def paragraphs(
    words: Words, length: int, bands: int, rows: int, met: set[int] | None = None, threshold: float = THRESHOLD
) -> tuple[np.ndarray, ...]:
    """Places of all paragraphs, the hash of each one's words, whether it is new to ``met``; of the new ones the band keys, parities and size; of all what ``runs`` says."""
    at = anchors(words, length)
    n = length - SHINGLE + 1
    grams = words.hash.copy()
    for k in range(1, SHINGLE):
        grams[:-k] = mix(grams[:-k] * np.uint64(_GOLD) + words.hash[k:])  # those over a text's end are not used
    own = grams[at[:, None] + np.arange(n)]
    order = np.array([(i + 1) * _GOLD & _WRAP for i in range(n)], np.uint64)
    content = mix((mix(own ^ np.uint64(0xA5A5)) * (order | np.uint64(1))).sum(1))
    met = set() if met is None else met
    new = np.zeros(len(at), bool)
    for i, c in enumerate(content.tolist()):
        if c not in met:
            new[i] = True
            met.add(c)
    bits, size = parity(own)
    run, alone = runs(own, bits, size, words.doc[at], content, threshold)
    own = own[new]
    keys = np.empty((len(own), bands), np.uint64)
    for b in range(bands):
        key = np.full(len(own), np.uint64(b + 1))
        for r in range(rows):
            seed = np.uint64((b * rows + r + 1) * 0xD6E8FEB86659FD93 & _WRAP)
            least = mix(own ^ seed).min(1) if len(own) else np.zeros(0, np.uint64)
            key = mix(key * np.uint64(_GOLD) + least)
        keys[:, b] = key
    return at, content, new, keys, bits[new], size[new], run, alone


def _places(docs: DataFrame, length: int, bands: int, rows: int, threshold: float) -> DataFrame:
    """A row for each paragraph; run is null where it is alone in it, parity, size and band keys where the task has met its words before."""
    schema = "content long, doc_id long, text_hash long, start int, end int, run long, size int, parity long"
    schema += "".join(f", band_{b} long" for b in range(bands))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        met: set[int] = set()
        for batch in batches:
            texts, ids, hashes = batch.column(1).to_pylist(), np.asarray(batch.column(0)), np.asarray(batch.column(2))
            for a, b in pieces(texts):
                words = words_of(texts[a:b])
                at, content, new, keys, bits, size, run, alone = paragraphs(words, length, bands, rows, met, threshold)
                if len(met) > _MET:
                    met.clear()
                doc, row = words.doc[at], np.cumsum(new) - 1
                start, end = words.start[at].astype(np.int32), words.end[at + length - 1].astype(np.int32)
                columns = [pa.array(x) for x in (content.view(np.int64), ids[a:b][doc], hashes[a:b][doc], start, end)]
                columns.append(pa.array(run, mask=alone))
                for values in (size.astype(np.int32), bits.view(np.int64), *keys.view(np.int64).T):
                    columns.append(pa.array(values[row] if len(values) else np.zeros(len(at), values.dtype), mask=~new))
                yield pa.RecordBatch.from_arrays(columns, [x.split()[0] for x in schema.split(", ")])

    return docs.mapInArrow(task, schema)


def _pairs(node: np.ndarray, bits: np.ndarray, size: np.ndarray, run: np.ndarray, counts: np.ndarray, threshold: float) -> np.ndarray:
    """Pairs of nodes of one bucket (``counts`` rows each), of different runs, whose parities leave the similarity possible."""
    end = np.repeat(np.cumsum(counts), counts)
    out, at = [np.zeros((0, 2), np.int64)], np.arange(len(node))
    for k in range(1, int(counts.max(initial=0))):
        at = at[at + k < end[at]]
        good = at[(run[at] != run[at + k]) & _near(bits[at], size[at], bits[at + k], size[at + k], threshold)]
        out.append(np.c_[node[good], node[good + k]])
    return np.concatenate(out)


def _meetings(rows: DataFrame, threshold: float) -> DataFrame:
    """What meets in the buckets of (bucket, node, size, parity): pairs (a, b), and (bucket, a) for each node of a bucket of more than CROWD.

    With a column ``run``, pairs of one run are left out: they are linked already.
    """
    if "run" not in rows.columns:
        rows = rows.withColumn("run", F.col("node"))

    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[list[np.ndarray] | None]:
        held, n = [], 0
        for batch in batches:
            held.append([np.asarray(c) for c in batch.columns])
            n += batch.num_rows
            if n >= _CHUNK:
                yield [np.concatenate(c) for c in zip(*held)]
                held, n = [], 0
        if held:
            yield [np.concatenate(c) for c in zip(*held)]

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Rows come by bucket. A chunk's last bucket waits for the next chunk; of a large one the nodes are given out at once, and remembered up to a number.
        held, open_, given = None, None, set()
        for chunk in itertools.chain(chunks(batches), [None]):
            if chunk is None and held is None:
                return
            parts = [x for x in (held, chunk) if x is not None]
            columns = [np.concatenate(c) for c in zip(*parts)]
            order = np.lexsort((columns[1], columns[0]))
            bucket, node = columns[0][order], columns[1][order]
            other = np.r_[True, bucket[1:] != bucket[:-1]]
            stay = other | np.r_[True, node[1:] != node[:-1]]
            bucket, node, size, bits, run = (x[order][stay] for x in columns)
            starts = np.flatnonzero(other[stay])
            counts = np.diff(np.r_[starts, len(bucket)])
            large = counts > CROWD
            again = bucket[0] == open_
            large[0] |= again
            crowd = np.repeat(large, counts)
            small = ~crowd
            if again:
                crowd[: counts[0]] = [n not in given for n in node[: counts[0]].tolist()]
            held = None
            if chunk is not None and large[-1]:
                if bucket[-1] != open_ or len(given) > _MET:
                    given = set()
                open_ = bucket[-1]
                given.update(node[starts[-1] :].tolist())
            elif chunk is not None:
                held = [x[starts[-1] :] for x in (bucket, node, size, bits, run)]
                small[starts[-1] :] = False
                large[-1] = True  # not yet
            pairs = _pairs(node[small], bits[small].view(np.uint64), size[small], run[small], counts[~large], threshold)
            none = pa.nulls(len(pairs), pa.int64()), pa.nulls(int(crowd.sum()), pa.int64())
            columns = [
                pa.concat_arrays([none[0], pa.array(bucket[crowd])]),
                pa.array(np.r_[pairs[:, 0], node[crowd]]),
                pa.concat_arrays([pa.array(pairs[:, 1].copy()), none[1]]),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["bucket", "a", "b"])

    dealt = rows.select("bucket", "node", "size", "parity", "run").repartition("bucket").sortWithinPartitions("bucket")
    return dealt.mapInArrow(task, "bucket long, a long, b long")


def _texts_of(docs: DataFrame, once: DataFrame) -> DataFrame:
    """(node, text): the words of the nodes among ``once``, each from its first place."""
    wanted = once.where("node is not null").groupBy(F.col("first.doc_id").alias("of"), F.col("first.text_hash").alias("of_text"))
    wanted = wanted.agg(F.collect_list(F.struct("content", "first.start", "first.end")).alias("wanted"))
    same = (F.col("doc_id") == F.col("of")) & (F.col("text_hash") == F.col("of_text"))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nodes, parts = [], []
            for text, wanted in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                nodes += [w["content"] for w in wanted]
                parts += [text[w["start"] : w["end"]] for w in wanted]
            yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array(parts, pa.string())], ["node", "text"])

    return docs.join(wanted, same).select("text", "wanted").mapInArrow(task, "node long, text string")


def _alike(pairs: DataFrame, texts: DataFrame, threshold: float) -> DataFrame:
    """The pairs (a, b) of paragraphs whose sets of shingles have that Jaccard similarity."""

    def compare(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for sides in batches:
            n = len(sides[0])
            items, of, _ = zip(*(weighted(*shingles(words_of(side.to_pylist()), SHINGLE)) for side in sides))
            _, row, times = weighted(np.concatenate(items), np.concatenate(of))
            shared, whole = np.bincount(row[times == 2], minlength=n), np.bincount(row, minlength=n)
            yield pa.array(shared / np.maximum(whole, 1) >= threshold - 1e-9)

    compare.__annotations__ = {"batches": Iterator[tuple[pa.Array, pa.Array]], "return": Iterator[pa.Array]}
    side = lambda s: texts.select(F.col("node").alias(f"{s}_node"), F.col("text").alias(f"{s}_text"))
    joined = pairs.join(side("b"), F.col("b") == F.col("b_node")).join(side("a"), F.col("a") == F.col("a_node"))
    good = F.arrow_udf(compare, "boolean")(F.col("a_text"), F.col("b_text"))
    return joined.select("a", "b", good.alias("good")).where("good").select("a", "b")


def _met(found: DataFrame, bands: int, threshold: float) -> tuple[DataFrame, DataFrame]:
    """Pairs (a, b) that meet in bands of up to CROWD paragraphs, and the (bucket, node) of larger ones."""
    met = []
    for b in range(bands):
        rows = found.where("size is not null").select(
            F.col(f"band_{b}").alias("bucket"), F.col("content").alias("node"), "size", "parity", F.coalesce("run", "content").alias("run")
        )
        met.append(staged(_meetings(rows, threshold), "meetings"))
    every = met[0]
    for more in met[1:]:
        every = every.unionByName(more)
    pairs = staged(every.where("bucket is null").select("a", "b").distinct(), "pairs")
    crowds = staged(every.where("bucket is not null").select("bucket", F.col("a").alias("node")), "crowds")
    for part in met:
        drop(part)
    return pairs, crowds


def _links_of_runs(found: DataFrame, once: DataFrame, links: DataFrame) -> DataFrame:
    """(a, b) that link the paragraphs of each run that another document or another link may join; the other runs are of one document."""
    members = staged(found.where("run is not null").select("content", "run").distinct(), "runs")
    met = once.where("run is not null and first.doc_id <> last").select("content")
    for side in ("a", "b"):
        met = met.unionByName(links.select(F.col(side).alias("content")))
    wanted = members.join(met, "content", "left_semi").select("run").distinct()
    wanted = members.join(wanted, "run", "left_semi").where("content <> run")
    return staged(wanted.select(F.col("content").alias("a"), F.col("run").alias("b")), "links")


def _labels(docs: DataFrame, found: DataFrame, once: DataFrame, pairs: DataFrame, crowds: DataFrame, threshold: float) -> DataFrame:
    """(node, label) of paragraphs of different words that are linked."""
    texts = staged(_texts_of(docs, once), "paragraph-texts")
    # Each paragraph's smallest partner first: most of a group of copies are in one component then.
    first = staged(pairs.groupBy("b").agg(F.min("a").alias("a")).select("a", "b"), "first-pairs")
    links = staged(_alike(first, texts, threshold), "links")
    named = components(links)
    rest = labelled(labelled(pairs.join(first, ["a", "b"], "left_anti"), "a", named, "a_label"), "b", named, "b_label")
    rest = staged(rest.where("a_label <> b_label").select("a", "b"), "pairs")
    links = links.unionByName(staged(_alike(rest, texts, threshold), "links"))
    if not crowds.isEmpty():

        def sets_of(nodes: DataFrame) -> DataFrame:
            own = texts.join(nodes.select(F.col("node").alias("of")), F.col("node") == F.col("of"), "left_semi")
            sets = shingle_sets(own.dropDuplicates(["node"]).select("node", "text"), SHINGLE)
            return sets.withColumn("weights", F.transform("weights", lambda w: F.lit(1)))

        links = links.unionByName(link(crowds, sets_of, threshold)[0])
    links = staged(links, "links")
    labels = components(links.unionByName(_links_of_runs(found, once, links)))
    for part in (pairs, first, rest, texts):
        drop(part)
    return labels


def repeats(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    length: int = LENGTH,
    threshold: float = THRESHOLD,
    bands: int = BANDS,
    rows: int = ROWS,
) -> DataFrame:
    """(doc_id, text_hash, start, end, class_id, kept) for each paragraph that more than one document holds.

    ``text_hash`` is xxhash64 of the text, which tells texts of one doc_id apart.
    """
    docs = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).where("doc_id is not null")
    docs = docs.withColumn("text_hash", F.xxhash64("text"))
    found = staged(_places(docs, length, bands, rows, threshold), "paragraphs", **_PLAIN)
    pairs, crowds = _met(found, bands, threshold)
    nodes = pairs.select(F.explode(F.array("a", "b")).alias("node")).unionByName(crowds.select("node")).distinct()
    place = F.struct("doc_id", "start", "text_hash", "end")
    once = found.groupBy("content").agg(F.min(place).alias("first"), F.max("doc_id").alias("last"), F.max("run").alias("run"))
    once = once.join(staged(nodes, "nodes"), F.col("content") == F.col("node"), "left")
    once = staged(once.where("node is not null or run is not null or first.doc_id <> last"), "met-or-repeated")
    labels = _labels(docs, found, once, pairs, crowds, threshold)
    named = labels.unionByName(labels.select(F.col("label").alias("node"), "label")).distinct()
    once = once.drop("node").join(named, F.col("content") == F.col("node"), "left").where("label is not null or first.doc_id <> last")
    once = staged(once.select("content", F.coalesce("label", "content").alias("class_id"), "first", "last"), "repeated")
    classes = once.groupBy(F.col("class_id").alias("class")).agg(F.min("first").alias("kept_at"), F.max("last").alias("last"))
    classes = classes.where("kept_at.doc_id <> last").select("class", "kept_at")
    repeated = once.join(classes, F.col("class_id") == F.col("class")).select(F.col("content").alias("of"), "class_id", "kept_at")
    places = found.select("content", "doc_id", "text_hash", "start", "end").join(staged(repeated, "passage-classes"), F.col("content") == F.col("of"))
    own = (place == F.col("kept_at")).alias("kept")
    return places.select("doc_id", "text_hash", "start", "end", "class_id", own).distinct()


def removals(found: DataFrame) -> DataFrame:
    """(doc_id, text_hash, spans): what to cut from each text, as disjoint spans in order.

    In repetitive text paragraphs of a class overlap; the one that is kept stays whole.
    """
    before = Window.partitionBy("doc_id", "text_hash").orderBy("start", "end").rowsBetween(Window.unboundedPreceding, -1)
    upto = Window.partitionBy("doc_id", "text_hash").orderBy("start", "end")
    held = F.max(F.when(F.col("kept"), F.col("end"))).over(Window.partitionBy("doc_id", "text_hash", "class_id"))
    rows = found.select("doc_id", "text_hash", "end", "kept", F.greatest("start", held).alias("start")).where("not kept")
    rows = rows.select("doc_id", "text_hash", "start", "end", F.max("end").over(before).alias("reach"))
    rows = rows.withColumn("island", F.sum((F.col("reach").isNull() | (F.col("start") > F.col("reach"))).cast("int")).over(upto))
    spans = rows.groupBy("doc_id", "text_hash", "island").agg(F.min("start").alias("start"), F.max("end").alias("end"))
    return spans.groupBy("doc_id", "text_hash").agg(F.array_sort(F.collect_list(F.struct("start", "end"))).alias("spans"))


def cut(text: Column, spans: Column) -> Column:
    """The text without the spans; a null array cuts nothing."""

    def rest(texts: pa.Array, rows: pa.Array) -> pa.Array:
        out = []
        for t, row in zip(texts.to_pylist(), rows.to_pylist()):
            if t is not None and row:
                starts, ends = [0, *(s["end"] for s in row)], [*(s["start"] for s in row), len(t)]
                t = "".join(t[a:b] for a, b in zip(starts, ends))
            out.append(t)
        return pa.array(out, pa.string())

    rest.__annotations__ = {"texts": pa.Array, "rows": pa.Array, "return": pa.Array}
    return F.arrow_udf(rest, "string")(text, spans)
