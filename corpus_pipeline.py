"""From documents to training tokens: five stages, each one of the operators in tidewater.llm."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.llm import bpe, decontam, lines, minhash, quality
from tidewater.llm.arrow import prepare_session
from tidewater.llm.staging import staged


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the text rules and score as trusted ones do.

    Null, empty and very short texts fail the rules. Each row is judged by its text alone, so repeated rows and null ids get
    what their text gets; without labelled documents the rules alone decide.
    """
    prepare_session(spark)
    model = quality.fit(docs, _table(spark, sf_dir, "labels"))
    return docs.where(quality.judge(docs["text"], model)["kept"])


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines that at least five of them hold, n_chars counted anew.

    Of equal lines the one in the largest doc_id stays; a null doc_id is below all others. A null text becomes empty. Rows
    of equal doc_id are one document for counting, and each keeps its own text. A column that is called like the
    operator's own result is carried under another name meanwhile.
    """
    prepare_session(spark)
    names, own = docs.columns, "line_stats"
    apart = max(names, key=len) + "_"  # longer than any name
    renamed = docs.withColumnRenamed(own, apart) if own in names else docs
    kept = lines.dedup_table(renamed).drop(own).withColumnRenamed(apart, own)
    return kept.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: that of the smallest doc_id.

    Rows of equal doc_id are one document, of which the smallest text stays. Texts without words have no copies, and rows
    without a doc_id stay.
    """
    prepare_session(spark)
    return minhash.one_of_each(docs, minhash.near_duplicates(docs))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage of a benchmark item.

    Each row is judged by its text, so a null or repeated doc_id makes no difference; null and empty texts stay.
    """
    prepare_session(spark)
    return decontam.clean(docs, _table(spark, sf_dir, "benchmark"))


def bpe_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' token ids, and whether they decode to the text they came from.

    A null text has no ids. Repeated rows give repeated rows.
    """
    prepare_session(spark)
    path = public_tokenizers.path("byte_bpe_50k.json")
    # The columns are held in a struct, so that none of them is taken for the tokens.
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"))
    text = F.coalesce(F.col("doc.text"), F.lit(""))
    coded = rows.select("doc", bpe.coded(text, path).alias("coded"))
    decoded = coded.select("doc", "coded.ids", (F.col("coded.decoded") == text).alias("round_trip"))
    return decoded.select(
        "doc.doc_id", "doc.lang", "doc.source", "doc.n_chars", F.size("ids").cast("long").alias("n_tokens"), "ids", "round_trip"
    )


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("bpe_tokens", bpe_tokens),
]

# Scores of hashed n-grams, estimated similarities and alignments have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order; what a stage keeps is written once and read by the next."""
    docs = _table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
