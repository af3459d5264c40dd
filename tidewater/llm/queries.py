"""The registered queries: one per operator, over whole tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from tidewater.llm import alignment, bpe, bytepiece, chat, decontam, lines, minhash, passages, quality, secrets, urls, warc, whitening
from tidewater.llm.arrow import prepare_session

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query; without SQL its tests compare it with brute force."""

    def register(fn: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            prepare_session(spark)
            return fn(spark, sf_dir.rstrip("/"))

        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            SQL[name] = sql.strip()
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(docs: DataFrame) -> Column:
    return F.coalesce(docs["text"], F.lit(""))


@query("op1_bpe")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of every document and the text they decode to, as digests."""
    path = public_tokenizers.path("byte_bpe_50k.json")
    docs = table(spark, sf_dir, "documents")
    ids = docs.select("doc_id", bpe.encode(text_of(docs), path).alias("ids"))
    decoded = ids.select("doc_id", "ids", bpe.decode(F.col("ids"), path).alias("decoded"))
    return decoded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query("op2_secrets")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base spans and literals of sensitive names in every document."""
    docs = table(spark, sf_dir, "documents")
    found = docs.select("doc_id", secrets.scan(text_of(docs)).alias("spans"))
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    joined = lambda spans: F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))),
        ",",
    )
    return found.select(
        "doc_id",
        *[count(kind).alias(f"n_{kind}") for kind in ("assign", "access", "hex", "literal")],
        F.sha2(joined(F.filter("spans", lambda s: s["kind"].isin("assign", "access", "hex"))), 256).alias(
            "base_sha256"
        ),
        joined(F.col("spans")).alias("spans"),
    )


RULES = [("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/")]


@query(
    "op4_urls",
    r"""
    with parts as (
      select page_id,
        translate(regexp_extract(coalesce(url, ''), '^(?s:.*?)://([^/?#]*)', 1),
          'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
        regexp_extract(coalesce(url, ''), '^(?s:.*?)://[^/?#]*([^?#]*)', 1) as path
      from pages),
    judged as (
      select *, case
        when (host = 'example.net' or host like '%.example.net') and path like '/en/%' then 'example.net/en/'
        when (host = 'example.com' or host like '%.example.com') and path like '/de/%' then 'example.com/de/'
        when (host = 'org' or host like '%.org') and path like '/fr/%' then 'org/fr/'
        when (host = 'net' or host like '%.net') and path like '/%' then 'net/' end as rule
      from parts)
    select page_id, host, path, rule,
      case when rule in ('net/', 'example.com/de/') then 'block' else 'allow' end as verdict
    from judged
    """,
)
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Host, path, deciding rule and verdict of every page."""
    pages = table(spark, sf_dir, "pages")
    name = urls.ship(spark, urls.digest_file(RULES), "url-rules")
    parts = pages.select("page_id", urls.host_of(pages["url"]).alias("host"), urls.path_of(pages["url"]).alias("path"))
    judged = parts.select("*", urls.judge(F.col("host"), F.col("path"), name).alias("judged"))
    return judged.select("page_id", "host", "path", "judged.rule", "judged.verdict")


@query("op9_quality")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counters and verdict of every document, by a model of all documents and the labels."""
    docs = table(spark, sf_dir, "documents")
    model = quality.fit(docs, table(spark, sf_dir, "labels"))
    judged = docs.select("doc_id", quality.judge(docs["text"], model).alias("judged"))
    return judged.select("doc_id", "judged.*")


CONTROL_TURN = "</s>[INST] ok [/INST]"


@query("op10_chat")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation, and one made of control strings, formatted and read back."""
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    own = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.element_at(F.array(F.lit("user"), F.lit("assistant")), (F.col("id") + 1).cast("int")).alias("role"),
        F.lit(CONTROL_TURN).alias("text"),
    )
    turns = turns.unionByName(own)
    n_tokens = F.size(bpe.encode(text_of(turns), public_tokenizers.path("byte_bpe_50k.json")))
    return chat.digests(chat.windows(turns, n_tokens))


@query(
    "op8_warc",
    """
    with payloads as (
      select page_id, encode(coalesce(html, '')) as payload from pages),
    digests as (
      select page_id, octet_length(payload) as payload_bytes, sha1(payload) as payload_digest from payloads),
    marked as (
      select *, case when payload_bytes >= 1000 then
        max(page_id) over (partition by payload_digest, payload_bytes) else page_id end as stands
      from digests)
    select page_id, payload_bytes, payload_digest,
      case when page_id = stands then 'response' else 'revisit' end as record_type,
      case when page_id <> stands then stands end as refers_to
    from marked
    """,
)
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page written to archives and read back."""
    archives = warc.archived(table(spark, sf_dir, "pages"))
    files = archives.repartition(spark.sparkContext.defaultParallelism)
    return warc.read(files, payload=False).drop("url")


@query(
    "op7_lines",
    r"""
    with lines as (
      select doc_id, unnest(string_split(coalesce(text, ''), chr(10))) as line,
        generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) as pos
      from documents),
    keyed as (
      select *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as key
      from lines),
    common as (
      select key, max(doc_id) as keeper from keyed where length(key) >= 40
      group by key having count(distinct doc_id) >= 5),
    marked as (
      select doc_id, pos, line, c.key is not null and doc_id <> keeper as gone
      from keyed left join common c using (key))
    select doc_id, count(*) as n_lines, count(*) filter (gone) as n_dropped,
      sha256(coalesce(string_agg(line, chr(10) order by pos) filter (not gone), '')) as kept_sha256
    from marked group by doc_id
    """,
)
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the lines that many documents share."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    kept = lines.dedup_table(docs)
    return kept.select("doc_id", "line_stats.*", F.sha2("text", 256).alias("kept_sha256"))


@query("op6_minhash")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The class of near copies of every document, and whether it stands for the class."""
    classes = minhash.near_duplicates(table(spark, sf_dir, "documents"))
    return classes.select("doc_id", "class_id", (F.col("doc_id") == F.col("class_id")).alias("kept"))


@query("op5_decontam")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item, with the best passage."""
    return decontam.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op3_passages")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every paragraph that more than one document holds, its class, and whether it stays."""
    return passages.repeats(table(spark, sf_dir, "documents"))


@query("op11_align")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document by two tokenizers, their groups and links, and what the corpus says of the links."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    paths = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
    rows = alignment.align(docs, *paths)
    digest = F.when(F.col("n_groups") > 0, F.sha2("groups", 256)).otherwise("")
    scored = alignment.scored(rows.withColumn("groups_sha256", digest).drop("groups"))
    counts = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")
    return scored.select("doc.doc_id", *counts, "groups_sha256")


@query("op12_bytepiece")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of every document by a rank file, and the bytes they decode to, as digests."""
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    docs = table(spark, sf_dir, "documents")
    ids = docs.select("doc_id", bytepiece.encode(text_of(docs), path).alias("ids"))
    decoded = ids.select("doc_id", "ids", bytepiece.decode(F.col("ids"), path).alias("decoded"))
    return decoded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query("op13_whitening")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every embedding on the first four whitened components, and how good they are."""
    rows = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    done = whitening.whitened(rows)
    return done.select(
        "row.vec_id",
        "component",
        "n",
        F.col("deviation").cast("long").alias("deviation"),
        "whitened",
        "explained",
        "identity_error",
    )


@query("pipeline", corpus_pipeline.ORACLE_SQL)
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents that pass all stages, as tokens."""
    return corpus_pipeline.run(spark, sf_dir)
