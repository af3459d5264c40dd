"""Screen corpus: texts from trees, embeddings, extraction."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.functions import json_text
from tidewater.operators.corpus import (
    embed,
    flatten_tree,
    not_embedded,
    payload_with_output,
    screen_text,
    with_extraction,
)
from tidewater.operators.merge import require_unique, update_by_key


def parse_screens(metadata: DataFrame, trees: DataFrame, key: str = "screen_id") -> DataFrame:
    """Metadata with the text of each screen as its JSON payload."""
    texts = flatten_tree(trees, key).select(
        key,
        F.to_json(F.struct(screen_text("elements").alias("texts"))).alias("extraction_payload"),
        F.current_timestamp().alias("updated_at"),
    )
    require_unique(trees, [key], "tree table")
    return update_by_key(metadata, texts, key, check=False)


def payload_text() -> Column:
    """The text of a screen's payload; empty if it has none."""
    return json_text("extraction_payload", "text_rep", "texts", default="")


def embed_new_texts(
    metadata: DataFrame, embeddings: DataFrame, encoder: Callable, model_name: str, model_version: str,
    run_id: str | None = None, key: str = "screen_id",
) -> DataFrame:
    """Embeddings of the screens that have none of this model yet."""
    todo = not_embedded(metadata, embeddings, key, "text", model_name, model_version)
    return embed(
        todo.withColumn("text", payload_text()), key, "text", encoder, "text", model_name, model_version, run_id
    )


def extract_screens(metadata: DataFrame, generator: Callable, **options) -> DataFrame:
    """Metadata with the model's output set in the payload, and the hash of the text it saw.

    The output becomes a column of the same rows, so nothing has to be joined.
    """
    made = with_extraction(metadata, json_text("extraction_payload", "texts", default=""), generator, **options)
    return made.withColumns(
        {"extraction_payload": payload_with_output("extraction_payload"), "updated_at": F.current_timestamp()}
    ).select(*metadata.columns)
