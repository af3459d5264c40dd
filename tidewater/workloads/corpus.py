"""Corpus jobs over documents, labels and embeddings.

A document stands for a screen: its lines are the nodes of a tree, from the
bottom of the screen up. The models are small deterministic functions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.functions import computed_once, fingerprint, json_double, json_text
from tidewater.operators import corpus, retrieval, trees
from tidewater.plans import screens
from tidewater.session import fresh_path, staged
from tidewater.workloads.registry import query
from tidewater.workloads.shapes import table


def _trees(spark: SparkSession, sf: str, key: str = "doc_id") -> DataFrame:
    """Documents as JSON trees; English ones are wrapped the way an app dump is."""
    # The lines are there before they are numbered: in an expression each line would split the text again.
    docs = table(spark, sf, "documents").select(F.col("doc_id").alias(key), "lang", "text")
    docs = computed_once(docs, [key, "lang"], "lines", F.split("text", "\n"))
    lines = F.col("lines")
    nodes = F.transform(
        lines,
        lambda line, i: F.struct(
            F.lit("line").alias("class"),
            line.alias("text"),
            F.array(F.lit(0), F.size(lines) - i, F.lit(9), F.lit(9)).alias("bounds"),
        ),
    )
    root = F.struct(F.col("lang").alias("class"), nodes.alias("children"))
    wrapped = F.to_json(F.struct(F.struct(root.alias("root")).alias("activity")))
    tree = F.when(F.col("lang") == "en", wrapped).otherwise(F.to_json(root))
    return docs.select(key, tree.alias("tree"))


# The characters that end a trimmed text.
_BLANK = r"[\t-\r\x1c- \x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
_STRIPPED = f"regexp_replace(regexp_replace(line, '^{_BLANK}+', ''), '{_BLANK}+$', '')"
_LINES_SQL = f"""
raw as (
  select doc_id, lang, unnest(string_split(text, chr(10))) as line,
         generate_subscripts(string_split(text, chr(10)), 1) as i,
         len(string_split(text, chr(10))) as n
  from documents),
nodes as (select doc_id, lang, i, n, {_STRIPPED} as text from raw)"""


_FLAT_SQL = f"""
with {_LINES_SQL}
select doc_id, 0::bigint as place, lang as cls, '' as text, 0 as top from documents where lang is not null
union all
select doc_id, (i - case when lang is null then 1 else 0 end)::bigint, 'line', text, (n - i + 1)::int from nodes"""


@query("flatten_tree", _FLAT_SQL)
def flatten_tree(spark: SparkSession, sf: str) -> DataFrame:
    flat = corpus.flatten_tree(_trees(spark, sf), "doc_id")
    return flat.select("doc_id", F.posexplode("elements").alias("place", "e")).select(
        "doc_id", F.col("place").cast("bigint").alias("place"), "e.cls", "e.text", F.col("e.bounds")[1].alias("top")
    )


@query("flatten_tree_by_level", _FLAT_SQL)
def flatten_tree_by_level(spark: SparkSession, sf: str) -> DataFrame:
    """The same by VARIANT functions alone."""
    flat = trees.flatten_tree_by_level(_trees(spark, sf), "doc_id")
    return flat.select("doc_id", F.posexplode("elements").alias("place", "e")).select(
        "doc_id", F.col("place").cast("bigint").alias("place"), "e.cls", "e.text", F.col("e.bounds")[1].alias("top")
    )


_TEXTS_SQL = f"""
{_LINES_SQL},
texts as (
  select d.doc_id, coalesce(string_agg(nodes.text, ' ' order by i desc) filter (where nodes.text <> ''), '') as t
  from documents d left join nodes using (doc_id) group by 1)"""


@query("screen_text", f"with {_TEXTS_SQL} select doc_id, sha256(t) as fp, length(t) as n from texts")
def screen_text(spark: SparkSession, sf: str) -> DataFrame:
    flat = corpus.flatten_tree(_trees(spark, sf), "doc_id").select("doc_id", corpus.screen_text("elements").alias("t"))
    return flat.select("doc_id", fingerprint("t").alias("fp"), F.length("t").cast("bigint").alias("n"))


# -- embeddings --------------------------------------------------------------

LETTERS = "aeiourst"


def letter_encoder():
    """An encoder of texts: how often each of a few letters occurs."""
    letters = LETTERS

    def load():
        import numpy as np

        return lambda texts: np.array([[text.count(c) for c in letters] for text in texts])

    return load


def size_encoder():
    """An encoder of bytes: their number, and the number of line ends."""

    def load():
        import numpy as np

        return lambda blobs: np.array([[len(blob), bytes(blob).count(b"\n")] for blob in blobs])

    return load


def _wide(vectors: DataFrame, n: int, key: str = "doc_id") -> DataFrame:
    parts = [F.col("embedding")[i].cast("double").alias(f"e{i}") for i in range(n)]
    return vectors.select(key, *parts, "embedding_kind", "source_fingerprint")


_COUNTS = ", ".join(f"(length(text) - length(replace(text, '{c}', '')))::double as c{i}" for i, c in enumerate(LETTERS))
_SQUARES = " + ".join(f"c{i} * c{i}" for i in range(len(LETTERS)))
_UNIT = ", ".join(
    f"(case when sq > 0 then c{i} / sqrt(sq) when sq = 0 then 0 end)::float::double as e{i}" for i in range(len(LETTERS))
)


@query("embed_text", f"""
with c as (select doc_id, text, {_COUNTS} from documents), s as (select *, {_SQUARES} as sq from c)
select doc_id, {_UNIT}, 'text' as embedding_kind, sha256(text) as source_fingerprint from s""")
def embed_text(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    return _wide(corpus.embed(docs, "doc_id", "text", letter_encoder(), "text", "letters", "1"), len(LETTERS))


@query("embed_images", """
with c as (select page_id, html, octet_length(encode(html))::double as c0,
                  (length(html) - length(replace(html, chr(10), '')))::double as c1 from pages)
select page_id, (c0 / sqrt(c0 * c0 + c1 * c1))::float::double as e0, (c1 / sqrt(c0 * c0 + c1 * c1))::float::double as e1,
       'image' as embedding_kind, sha256(html) as source_fingerprint from c""")
def embed_images(spark: SparkSession, sf: str) -> DataFrame:
    """Whole binary objects; the bytes of the pages stand for pictures."""
    blobs = table(spark, sf, "pages").select("page_id", F.col("html").cast("binary").alias("content"))
    return _wide(corpus.embed(blobs, "page_id", "content", size_encoder(), "image", "sizes", "1"), 2, "page_id")


@query("not_embedded", "select doc_id from documents where doc_id not in (select doc_id from labels)")
def not_embedded(spark: SparkSession, sf: str) -> DataFrame:
    """Labelled documents have an embedding of the model, and another model has them all."""
    docs = table(spark, sf, "documents").select("doc_id")

    def done(ids: DataFrame, version: str) -> DataFrame:
        return ids.select(
            "doc_id", F.lit("letters").alias("model_name"), F.lit(version).alias("model_version"),
            F.lit("text").alias("embedding_kind"),
        )

    have = done(table(spark, sf, "labels"), "1").unionByName(done(docs, "0"))
    return corpus.not_embedded(docs, have, "doc_id", "text", "letters", "1")


# -- extraction --------------------------------------------------------------


def length_generator():
    """A generator whose confidence follows from the length of the prompt."""

    def load():
        def generate(prompts):
            sizes = [len(p) for p in prompts]
            return ["sorry" if n % 5 == 0 else '{"title": "t", "confidence": %s}' % (n % 100 / 100) for n in sizes]

        return generate

    return load


def _made_sql(texts: str, key: str, text: str) -> str:
    return f"""
made as (
  select *, case when n % 5 = 0 then 0 else (n % 100)::double / 100 end as confidence, n % 5 <> 0 as parsed
  from (select {key}, coalesce({text}, '') as body, length('{corpus.PROMPT}' || coalesce({text}, '')) as n from {texts}))"""


@query("extract", f"""
with {_made_sql('documents', 'doc_id', 'text')}
select doc_id, confidence, parsed, 'v1' as prompt_version, sha256(body) as source_fingerprint from made""")
def extract(spark: SparkSession, sf: str) -> DataFrame:
    return corpus.extract(table(spark, sf, "documents"), "doc_id", "text", length_generator()).drop("output")


@query("review_queue", f"""
with {_made_sql('documents', 'doc_id', 'text')}
select doc_id, sha256(body) as source_fingerprint,
       case when parsed then 'low_confidence' else 'unparsable' end as reason
from made where not parsed or confidence < 0.5""")
def review_queue(spark: SparkSession, sf: str) -> DataFrame:
    made = corpus.extract(table(spark, sf, "documents"), "doc_id", "text", length_generator())
    return corpus.review_queue(made, "doc_id").drop("raw_output")


@query("screens", f"""
with {_TEXTS_SQL}, {_made_sql('texts', 'doc_id', 't')}
select doc_id as screen_id, sha256(body) as text_fp, confidence, sha256(body) as source_fingerprint from made""")
def run_screens(spark: SparkSession, sf: str) -> DataFrame:
    """Trees to texts, then the model's output into the same payload."""
    metadata = table(spark, sf, "documents").select(
        F.col("doc_id").alias("screen_id"),
        F.lit(None).cast("string").alias("extraction_payload"),
        F.lit(None).cast("timestamp").alias("updated_at"),
        F.lit("").alias("source_fingerprint"),
    )
    parsed = screens.parse_screens(metadata, _trees(spark, sf, "screen_id"))
    made = screens.extract_screens(parsed, length_generator())
    return made.select(
        "screen_id",
        fingerprint(json_text("extraction_payload", "texts", default="")).alias("text_fp"),
        json_double(F.get_json_object("extraction_payload", "$.llm"), "confidence").alias("confidence"),
        "source_fingerprint",
    )


@query("changed", """
select doc_id, sha256(text) as old_fingerprint, sha256(replace(text, 'the', 'THE')) as new_fingerprint
from documents where contains(text, 'the')""")
def changed(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    stored = docs.select("doc_id", fingerprint("text").alias("source_fingerprint"))
    now = docs.select("doc_id", F.replace("text", F.lit("the"), F.lit("THE")).alias("text"))
    return corpus.changed(stored, now, "doc_id", "text")


# -- retrieval ---------------------------------------------------------------


@query("recall_at_k", """
with parts as (
  select label, unnest(embedding)::double as x, generate_subscripts(embedding, 1) as i from embeddings),
means as (select label, i, avg(x) as x from parts group by 1, 2),
queries as (select label, list(x order by i) as q from means group by 1),
sims as (
  select q.label as asked, e.vec_id, e.label,
         round(list_cosine_similarity(q.q, e.embedding::double[]), 9) as sim from queries q, embeddings e),
near as (
  select *, row_number() over (partition by asked order by sim desc, vec_id) as rn from sims)
select null::varchar as embedding_model_version, count(*) as n_queries, round(avg(recall), 9) as recall_at_5 from (
  select asked, (count(*) filter (where asked = label))::double
                / (select count(*) from embeddings e where e.label = asked) as recall
  from near where rn <= 5 group by 1)""")
def recall_at_k(spark: SparkSession, sf: str) -> DataFrame:
    """One query per label, the mean of its vectors, against all vectors."""
    vectors = table(spark, sf, "embeddings")
    size = len(vectors.select("embedding").first()[0])
    mean = F.array(*[F.avg(F.col("embedding")[i].cast("double")) for i in range(size)])
    queries = vectors.groupBy("label").agg(mean.alias("embedding")).withColumn("vec_id", -1 - F.col("label"))
    return corpus.recall_at_k(vectors, queries).withColumn("recall_at_5", F.round("recall_at_5", 9))


@query("recall_per_version", """
with vectors as (select vec_id, label, embedding::double[] as e, 'v' || (vec_id % 2) as ver from embeddings),
parts as (select ver, label, unnest(e) as x, generate_subscripts(e, 1) as i from vectors),
means as (select ver, label, i, avg(x) as x from parts group by 1, 2, 3),
queries as (select ver, label, list(x order by i) as q from means group by 1, 2),
sims as (
  select v.ver, q.label as asked, v.vec_id, v.label, round(list_cosine_similarity(q.q, v.e), 9) as sim
  from queries q join vectors v on v.ver = q.ver),
near as (
  select *, row_number() over (partition by ver, asked order by sim desc, vec_id) as rn from sims),
members as (select ver, label as asked, count(*) as n from vectors group by 1, 2),
scores as (
  select ver, asked, count(*) filter (where asked = label) as hits from near where rn <= 5 group by 1, 2)
select ver as embedding_model_version, count(*) as n_queries, round(avg(hits::double / n), 9) as recall_at_5
from scores join members using (ver, asked) group by 1""")
def recall_per_version(spark: SparkSession, sf: str) -> DataFrame:
    """Two versions of the vectors; per version and label the mean vector asks."""
    version = F.concat(F.lit("v"), (F.col("vec_id") % 2).cast("string")).alias("embedding_model_version")
    vectors = table(spark, sf, "embeddings").select("*", version)
    size = len(vectors.select("embedding").first()[0])
    mean = F.array(*[F.avg(F.col("embedding")[i].cast("double")) for i in range(size)])
    queries = vectors.groupBy("embedding_model_version", "label").agg(mean.alias("embedding"))
    queries = queries.withColumn("vec_id", -1 - F.col("label"))
    found = corpus.recall_per_version(vectors, queries, ["v0", "v1"])
    return found.withColumn("recall_at_5", F.round("recall_at_5", 9))


_DIRECTED_SQL = """
v as (
  select vec_id, embedding::double[] as e from embeddings
  where list_count(embedding) = len(embedding) and list_aggregate(list_transform(embedding, lambda x: isfinite(x)), 'bool_and')
    and list_aggregate(list_transform(embedding, lambda x: x <> 0), 'bool_or'))"""
INDEX_RECALL = 0.9


def _index(spark: SparkSession, sf: str):
    """An index of all vectors, its queries (every id divisible by 50) and the lists a query probes."""
    vectors = table(spark, sf, "embeddings")
    corpus_rows = vectors.select(
        F.col("vec_id").alias("corpus_id"), "embedding", F.col("label").cast("int").alias("corpus_label")
    )
    asked = vectors.filter(F.col("vec_id") % 50 == 0).select(F.col("vec_id").alias("query_id"), "embedding")
    lists = max(1, min(4096, round(vectors.count() ** 0.5)))
    index = retrieval.build_index(corpus_rows, fresh_path(spark, "vector-lists"), lists)
    sample = retrieval.sample_of(corpus_rows, min(retrieval.SAMPLE_MOST, retrieval.SAMPLE_PER_LIST * lists))
    return index, asked, retrieval.probes_for(sample, index.centroids, 5, INDEX_RECALL + 0.03)


@query("index_search", f"""
with {_DIRECTED_SQL},
sims as (
  select q.vec_id as query_id, c.vec_id as corpus_id, round(list_cosine_similarity(q.e, c.e), 9) as sim
  from v q, v c where q.vec_id % 50 = 0 and q.vec_id <> c.vec_id),
near as (select *, row_number() over (partition by query_id order by sim desc, corpus_id) as place from sims)
select query_id, place::int as place, corpus_id, sim from near where place <= 5""")
def index_search(spark: SparkSession, sf: str) -> DataFrame:
    """The five nearest vectors of every query by the index, exactly."""
    index, asked, probes = _index(spark, sf)
    return retrieval.search_exact(index, asked, 5, probes).select("query_id", "place", "corpus_id", "sim")


@query("index_recall", f"""
with {_DIRECTED_SQL}
select count(*) as n_queries, {INDEX_RECALL}::double as recall, true as bounded from v
where vec_id % 50 = 0 having count(*) > 0""")
def index_recall(spark: SparkSession, sf: str) -> DataFrame:
    """Recall of a search in the probed lists against the exact one, counted up to the target, and whether
    a query's candidates are at most the vectors of its lists."""
    index, asked, probes = _index(spark, sf)
    found = staged(retrieval.search(index, asked, 5, probes), "found")
    exact = staged(retrieval.search_exact(index, asked, 5, probes), "exact")
    row = retrieval.search_recall(index, found, exact, probes).filter("n_queries > 0")
    return row.select(
        "n_queries",
        F.least("recall", F.lit(INDEX_RECALL)).alias("recall"),
        (F.col("most_candidates") <= int(index.sizes.sum())).alias("bounded"),
    )
