"""Run registry and run metrics."""

from __future__ import annotations

import uuid
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.functions import ratio, seconds_between
from tidewater.operators.dedup import latest_per_key
from tidewater.operators.gold import metrics_long
from tidewater.operators.merge import update_by_key

RUN_SCHEMA = (
    "run_id string, started_at timestamp, ended_at timestamp, status string, limit_param int, "
    "git_sha string, image_model_version string, text_model_version string, "
    "generator_version string, prompt_version string"
)


def start_run(spark: SparkSession, started_at: datetime | None = None, **versions) -> DataFrame:
    """One run row with a random id and status ``running``; versions fill the other columns."""
    row = {"run_id": str(uuid.uuid4()), "started_at": started_at or datetime.now(), "status": "running"}
    row |= versions
    names = [f.split()[0] for f in RUN_SCHEMA.split(", ")]
    return spark.createDataFrame([tuple(row.get(n) for n in names)], RUN_SCHEMA)


def finish_run(runs: DataFrame, run_id: str, ended_at: Column | None = None, status: str = "succeeded") -> DataFrame:
    """The registry with one run ended."""
    return finish_runs(runs, runs.filter(F.col("run_id") == run_id).select(
        "run_id",
        (ended_at if ended_at is not None else F.current_timestamp()).alias("ended_at"),
        F.lit(status).alias("status"),
    ))


def finish_runs(runs: DataFrame, ends: DataFrame) -> DataFrame:
    """The registry with every run ended that ``ends`` lists: run_id, ended_at, status.

    Of several ends of a run the latest counts, so a retry changes nothing.
    """
    return update_by_key(runs, latest_per_key(ends, ["run_id"], ["ended_at", "status"]), "run_id", check=False)


def run_duration(runs: DataFrame, run_id: str) -> DataFrame:
    """One row: seconds a run took; 0 while it has not ended."""
    seconds = seconds_between("started_at", "ended_at")
    return runs.filter(F.col("run_id") == run_id).agg(
        F.coalesce(F.max(seconds), F.lit(0)).cast("double").alias("run_duration_seconds")
    )


def run_metrics(
    metadata: DataFrame, embeddings: DataFrame, review: DataFrame, runs: DataFrame, run_id: str
) -> DataFrame:
    """The seven metrics of a run, as rows (run_id, metric_name, metric_value).

    Each table is reduced where it lies to one row of counts. The rows are
    stacked and folded into one, so no table meets another in a join.
    """
    meta = metadata.agg(
        F.count(F.lit(1)).cast("double").alias("metadata_rows"),
        F.count_distinct("app_package").cast("double").alias("distinct_app_packages"),
        F.count_distinct("category").cast("double").alias("distinct_categories"),
        F.count("extraction_payload").cast("double").alias("payloads"),
    )
    parts = [
        meta,
        embeddings.agg(F.count(F.lit(1)).cast("double").alias("embedding_rows")),
        review.agg(F.count(F.lit(1)).cast("double").alias("reviews")),
        run_duration(runs, run_id),
    ]
    stacked = parts[0]
    for part in parts[1:]:
        stacked = stacked.unionByName(part, allowMissingColumns=True)
    one = stacked.agg(*[F.max(c).alias(c) for c in stacked.columns])

    def pct(part: str) -> Column:
        return F.coalesce(ratio(F.lit(100.0) * F.col(part), F.col("metadata_rows")), F.lit(0.0))

    wide = one.select(
        "metadata_rows",
        "embedding_rows",
        "distinct_app_packages",
        "distinct_categories",
        pct("payloads").alias("extraction_payload_pct"),
        pct("reviews").alias("review_queue_pct"),
        "run_duration_seconds",
    )
    return metrics_long(wide, run_id)
