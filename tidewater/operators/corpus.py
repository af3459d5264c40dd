"""Screen-corpus jobs: UI trees, embeddings, extraction, review and retrieval evaluation.

Models are the caller's. An encoder factory returns a function from a list of
inputs to a matrix, a generator factory a function from prompts to texts; each is
called once per task and then fed Arrow batches.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewater.functions import fingerprint, json_double, json_set
from tidewater.session import staged

# The extraction prompt, its version, and the payload key of its output.
PROMPT = "You are an extractor. Return JSON with fields: title, elements, confidence. Text: "
PROMPT_VERSION = "v1"
OUTPUT_KEY = "llm"

ELEMENTS = "array<struct<cls:string,text:string,bounds:array<int>>>"


# -- trees -------------------------------------------------------------------


def tree_elements(tree: Column | str) -> Column:
    """The nodes of a UI tree in JSON, in depth-first order with parents first.

    Nodes without text and class are left out but their children are not. The
    walk starts at ``activity.root`` where there is one. A text that is not JSON, or
    nested deeper than the decoder goes, gives NULL. Bounds that are not four whole
    numbers of 32 bits become zeros. Nodes may lie at any depth, so this is a loop in Arrow batches.
    """
    end = object()

    def parents_first(root) -> Iterator[dict]:
        levels = [iter([root])]
        while levels:
            node = next(levels[-1], end)
            if node is end:
                levels.pop()
            elif isinstance(node, dict):
                yield node
                if isinstance(node.get("children"), list):
                    levels.append(iter(node["children"]))

    def start(doc):
        app = doc.get("activity") if isinstance(doc, dict) else None
        return app.get("root", doc) if isinstance(app, dict) else doc

    def label(node: dict, name: str) -> str:
        return str(node.get(name) or "").strip()

    def box(sides) -> list[int]:
        try:
            whole = [int(b) for b in sides]
        except (TypeError, ValueError, OverflowError):
            return [0, 0, 0, 0]
        return whole if len(whole) == 4 and all(-(2**31) <= b < 2**31 for b in whole) else [0, 0, 0, 0]

    def flat(texts: pa.Array) -> pa.Array:
        cls, text, bounds, sides, ends, missing = [], [], [], [0], [0], []
        for raw in texts.to_pylist():
            try:
                root = start(json.loads(raw))
                missing.append(False)
            except (TypeError, ValueError, RecursionError):
                root = None
                missing.append(True)
            for node in parents_first(root):
                pair = label(node, "class"), label(node, "text")
                if any(pair):
                    cls.append(pair[0])
                    text.append(pair[1])
                    bounds.extend(box(node.get("bounds")))
                    sides.append(len(bounds))
            ends.append(len(cls))
        boxes = pa.ListArray.from_arrays(pa.array(sides, pa.int32()), pa.array(bounds, pa.int32()))
        nodes = pa.StructArray.from_arrays(
            [pa.array(cls, pa.string()), pa.array(text, pa.string()), boxes], ["cls", "text", "bounds"]
        )
        return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), nodes, mask=pa.array(missing, pa.bool_()))

    @F.arrow_udf(ELEMENTS)
    def elements(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        yield from map(flat, parts)

    return elements(tree)


def flatten_tree(df: DataFrame, key: str, tree: str = "tree") -> DataFrame:
    """Rows (key, elements) of :func:`tree_elements`."""
    return df.select(key, tree_elements(tree).alias("elements"))


def screen_text(elements: Column | str) -> Column:
    """The texts of a screen, read by top, then left, joined by spaces."""
    elements = F.col(elements) if isinstance(elements, str) else elements
    placed = F.transform(
        elements,
        lambda e, i: F.struct(
            F.get(e["bounds"], F.lit(1)).alias("top"),
            F.get(e["bounds"], F.lit(0)).alias("left"),
            i.alias("place"),
            e["text"].alias("text"),
        ),
    )
    with_text = F.array_sort(F.filter(placed, lambda e: e["text"] != ""))
    return F.array_join(F.transform(with_text, lambda e: e["text"]), " ")


# -- models ------------------------------------------------------------------


def encoded(content: Column | str, encoder: Callable[[], Callable[[list], np.ndarray]]) -> Column:
    """Unit-length vectors of bytes or texts; NULL for NULL, which the encoder does not see."""

    @F.arrow_udf("array<float>")
    def vectors(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        encode = encoder()
        for part in parts:
            given = np.asarray(part.is_valid())
            count = int(given.sum())
            raw = np.asarray(encode(part.drop_null().to_pylist()) if count else np.zeros((0, 0)), dtype="float64")
            raw = raw.reshape(count, -1) if count else raw
            norms = np.sqrt((raw * raw).sum(axis=1, keepdims=True))
            unit = np.divide(raw, norms, out=np.zeros_like(raw), where=norms > 0).astype("float32")
            ends = np.concatenate([[0], np.cumsum(given * unit.shape[1])]).astype("int32")
            yield pa.ListArray.from_arrays(pa.array(ends), pa.array(unit.ravel()), mask=pa.array(~given))

    # Not deterministic to the optimizer, so that it never runs a model twice.
    return vectors.asNondeterministic()(content)


def embed(
    df: DataFrame,
    key: str,
    content: str,
    encoder: Callable[[], Callable[[list], np.ndarray]],
    kind: str,
    model_name: str,
    model_version: str,
    run_id: str | None = None,
) -> DataFrame:
    """Embedding rows with the hash of what was encoded.

    Only the content goes to Python and only the vectors come back; the key and
    the hash stay in Spark.
    """
    return df.select(
        key,
        F.lit(model_name).alias("model_name"),
        F.lit(model_version).alias("model_version"),
        F.lit(kind).alias("embedding_kind"),
        encoded(content, encoder).alias("embedding"),
        F.lit(run_id).cast("string").alias("run_id"),
        fingerprint(content).alias("source_fingerprint"),
    )


def not_embedded(
    df: DataFrame, done: DataFrame, key: str, kind: str, model_name: str, model_version: str
) -> DataFrame:
    """Rows that have no embedding of this kind and model yet, to be found before encoding."""
    same = done.filter(
        (F.col("embedding_kind") == kind)
        & (F.col("model_name") == model_name)
        & (F.col("model_version") == model_version)
    )
    return df.join(same.select(key), key, "left_anti")


def generated(prompt: Column, generator: Callable[[], Callable[[list[str]], list[str]]]) -> Column:
    """The model's output for each prompt."""

    @F.arrow_udf("string")
    def outputs(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        generate = generator()
        for part in parts:
            yield pa.array(generate(part.to_pylist()), pa.string())

    return outputs.asNondeterministic()(prompt)


def with_extraction(
    df: DataFrame,
    text: Column | str,
    generator: Callable[[], Callable[[list[str]], list[str]]],
    prompt: str = PROMPT,
    prompt_version: str = PROMPT_VERSION,
) -> DataFrame:
    """Rows with output, confidence, parsed, prompt_version and the hash of the text.

    The confidence is read from the output; 0.0 if the output is not such JSON.
    """
    body = F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))
    made = df.withColumn("output", generated(F.concat(F.lit(prompt), body), generator))
    return parse_output(made).withColumns(
        {"prompt_version": F.lit(prompt_version), "source_fingerprint": fingerprint(body)}
    )


def extract(df: DataFrame, key: str, text: Column | str, generator: Callable, **options) -> DataFrame:
    """The columns of :func:`with_extraction` beside the key."""
    return with_extraction(df, text, generator, **options).select(
        key, "source_fingerprint", "output", "confidence", "parsed", "prompt_version"
    )


def parse_output(made: DataFrame, output: str = "output") -> DataFrame:
    """Confidence of each model output and whether it is JSON at all."""
    return made.withColumn("confidence", json_double(output, "confidence")).withColumn(
        "parsed", F.try_parse_json(output).isNotNull()
    )


def payload_with_output(payload: Column | str) -> Column:
    """A JSON payload with the columns of :func:`extract` set under the output key."""
    made = F.to_variant_object(F.struct("output", "prompt_version", "confidence"))
    return json_set(payload, OUTPUT_KEY, made)


def review_queue(extractions: DataFrame, key: str, min_confidence: float = 0.5) -> DataFrame:
    """Rows a person has to look at: output that is not JSON, or of low or no confidence."""
    low = F.isnan("confidence") | (F.col("confidence") < min_confidence)
    return extractions.filter(~F.col("parsed") | low).select(
        key,
        "source_fingerprint",
        F.when(~F.col("parsed"), "unparsable").otherwise("low_confidence").alias("reason"),
        F.col("output").alias("raw_output"),
    )


def changed(stored: DataFrame, current: DataFrame, key: str, content: str) -> DataFrame:
    """Keys whose content no longer has the stored ``source_fingerprint``."""
    now = current.select(key, fingerprint(content).alias("__now"))
    return stored.join(now, key).filter(F.col("source_fingerprint") != F.col("__now")).select(
        key, F.col("source_fingerprint").alias("old_fingerprint"), F.col("__now").alias("new_fingerprint")
    )


# -- retrieval ---------------------------------------------------------------

# Similarities are compared after rounding, so that equal vectors tie whatever
# order a matrix product sums in; ties go to the smaller id.
SIMILARITY_DIGITS = 9
# Queries and corpus rows that meet in one group.
QUERY_BLOCK = 5_000
CORPUS_BLOCK = 50_000
NEAREST_SCHEMA = "query_id bigint, corpus_id bigint, sim double, corpus_label int"


def block_search(k: int):
    """Unit rows of a column of vectors, and the search of one block of rows for some queries."""
    names = ["query_id", "corpus_id", "sim", "corpus_label"]

    def unit(vectors) -> np.ndarray:
        rows = np.asarray(pc.list_flatten(vectors)).astype("float64").reshape(len(vectors), -1)
        return rows / np.maximum(np.linalg.norm(rows, axis=1, keepdims=True), 1e-300)

    def search(query_ids: np.ndarray, query_rows: np.ndarray, part) -> Iterator[pa.RecordBatch]:
        corpus_ids = np.asarray(part.column("corpus_id"))
        rows = unit(part.column("embedding"))
        for at in range(0, len(query_ids), 256):
            ids = query_ids[at : at + 256]
            sims = np.round(query_rows[at : at + 256] @ rows.T, SIMILARITY_DIGITS)
            sims[ids[:, None] == corpus_ids[None, :]] = -np.inf
            nth = min(k, sims.shape[1]) - 1
            floor = -np.partition(-sims, nth, axis=1)[:, nth : nth + 1]
            q, c = np.nonzero((sims >= floor) & (sims > -np.inf))
            order = np.lexsort((corpus_ids[c], -sims[q, c], q))
            q, c = q[order], c[order]
            place = np.arange(len(q)) - np.searchsorted(q, q)
            q, c = q[place < k], c[place < k]
            labels = part.column("corpus_label").take(pa.array(c))
            labels = labels.combine_chunks() if isinstance(labels, pa.ChunkedArray) else labels
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids[q]), pa.array(corpus_ids[c]), pa.array(sims[q, c]), labels.cast(pa.int32())], names
            )

    return unit, search


def nearest(corpus: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """The k corpus rows nearest to each query by cosine, exactly.

    ``corpus`` has (corpus_id, embedding, corpus_label), ``queries`` (query_id,
    embedding); a corpus row with the query's own id is left out. Queries and corpus are cut into
    blocks, and each pair of blocks is one bounded group, which gives at most k
    rows per query; only those are shuffled for the final cut. The queries are
    staged, so that what they were computed from is read once.
    """
    unit, search = block_search(k)
    corpus = corpus.filter(F.col("embedding").isNotNull())
    queries = staged(queries.filter(F.col("embedding").isNotNull()).select("query_id", "embedding"), "queries")
    q_blocks = max(1, -(-queries.count() // QUERY_BLOCK))
    c_blocks = max(1, -(-corpus.count() // CORPUS_BLOCK))
    schema = pa.schema(
        [("query_id", pa.int64()), ("corpus_id", pa.int64()), ("sim", pa.float64()), ("corpus_label", pa.int32())]
    )

    def cell(q_part: pa.Table, c_part: pa.Table) -> pa.Table:
        found = []
        if len(q_part) and len(c_part):
            found = list(search(np.asarray(q_part.column("query_id")), unit(q_part.column("embedding")), c_part))
        return pa.Table.from_batches(found, schema)

    def every(n: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    def block(col: str, n: int) -> Column:
        return F.pmod(F.xxhash64(col), F.lit(n)).cast("int")

    left = queries.select(
        block("query_id", q_blocks).alias("qb"), every(c_blocks).alias("cb"), "query_id", "embedding"
    )
    right = corpus.select(
        every(q_blocks).alias("qb"), block("corpus_id", c_blocks).alias("cb"),
        "corpus_id", "embedding", "corpus_label",
    )
    near = left.groupBy("qb", "cb").cogroup(right.groupBy("qb", "cb")).applyInArrow(cell, NEAREST_SCHEMA)
    place = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("sim"), "corpus_id"))
    return near.withColumn("place", place).filter(F.col("place") <= k)


def recall_at_k(
    corpus: DataFrame, queries: DataFrame, k: int = 5, key: str = "vec_id", label: str = "label",
    version: str | None = None,
) -> DataFrame:
    """One row: number of queries and mean share of a query's relevant rows among its k nearest.

    Relevant are the corpus rows of the query's label, but for the query itself.
    """
    near = nearest(
        corpus.select(F.col(key).cast("bigint").alias("corpus_id"), "embedding", F.col(label).alias("corpus_label")),
        queries.select(F.col(key).cast("bigint").alias("query_id"), "embedding"),
        k,
    )
    found = near.groupBy("query_id", "corpus_label").agg(F.count(F.lit(1)).alias("hits"))
    asked = queries.select(F.col(key).cast("bigint").alias("query_id"), F.col(label).alias("query_label"))
    per_label = corpus.groupBy(F.col(label).alias("query_label")).agg(F.count(F.lit(1)).alias("members"))
    own = corpus.select(F.col(key).cast("bigint").alias("query_id"), F.col(label).alias("query_label"))
    itself = asked.join(own, ["query_id", "query_label"], "left_semi").select("query_id", F.lit(1).alias("self"))
    scored = (
        asked.join(per_label, "query_label", "left")
        .join(itself, "query_id", "left")
        .join(
            found.withColumnRenamed("corpus_label", "query_label"), ["query_id", "query_label"], "left"
        )
        .select(
            (
                F.coalesce("hits", F.lit(0)).cast("double")
                / F.nullif(F.coalesce("members", F.lit(0)) - F.coalesce("self", F.lit(0)), F.lit(0))
            ).alias("recall")
        )
    )
    return scored.agg(
        F.lit(version).cast("string").alias("embedding_model_version"),
        F.count(F.lit(1)).alias("n_queries"),
        F.avg("recall").alias(f"recall_at_{k}"),
    )


def recall_per_version(
    corpus: DataFrame, queries: DataFrame, versions: list[str], k: int = 5, of: str = "embedding_model_version", **names
) -> DataFrame:
    """A row of :func:`recall_at_k` per embedding version; queries meet the vectors of their own version only."""
    rows = [
        recall_at_k(corpus.filter(F.col(of) == v), queries.filter(F.col(of) == v), k, version=v, **names) for v in versions
    ]
    out = rows[0]
    for row in rows[1:]:
        out = out.unionByName(row)
    return out
