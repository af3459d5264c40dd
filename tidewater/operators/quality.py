"""Quality checks, gates, alerts, table health and audits."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.errors import DataQualityError
from tidewater.functions import channel, ratio
from tidewater.operators.dedup import count_duplicates, over
from tidewater.session import one_row, staged_by_small_tasks

# Thresholds of the checks.
MAX_NULL_RATE = 0.01
MIN_ROW_COUNT = 1
PAGE_FRESH_SECONDS = 60


@dataclass(frozen=True)
class TableChecks:
    """What to check about one table."""

    name: str
    primary_key: str
    critical_columns: list[str] = field(default_factory=list)
    max_null_rate: float = MAX_NULL_RATE
    min_rows: int = MIN_ROW_COUNT


def _facts(df: DataFrame, cfg: TableChecks) -> DataFrame:
    """One row: n, dup_keys, and nulls_<column> for each critical column.

    Counts are summed per key first and then over keys. One scan and one
    shuffle give all checks, and a hot key is reduced before the shuffle.
    """
    nulls = [F.count_if(F.col(c).isNull()).alias(f"nulls_{c}") for c in cfg.critical_columns]
    per_key = df.groupBy(F.col(cfg.primary_key).alias("__key")).agg(F.count(F.lit(1)).alias("__n"), *nulls)
    facts = per_key.agg(
        F.coalesce(F.sum("__n"), F.lit(0)).alias("n"),
        F.count_if(F.col("__n") > 1).alias("dup_keys"),
        *[F.coalesce(F.sum(f"nulls_{c}"), F.lit(0)).alias(f"nulls_{c}") for c in cfg.critical_columns],
    )
    return staged_by_small_tasks(facts, "facts")


def _worst(cfg: TableChecks) -> tuple[Column, Column]:
    """The largest null rate among the critical columns and its column."""
    rates = [
        F.struct(
            F.coalesce(ratio(F.col(f"nulls_{c}"), F.col("n")), F.lit(0.0)).alias("rate"),
            F.lit(-i).alias("place"),
            F.lit(c).alias("col"),
        )
        for i, c in enumerate(cfg.critical_columns)
    ]
    if not rates:
        return F.lit(0.0), F.lit(None).cast("string")
    top = rates[0] if len(rates) == 1 else F.greatest(*rates)
    return top["rate"], top["col"]


def pre_audit(df: DataFrame | None, cfg: TableChecks) -> DataFrame:
    """Rows (table_name, check, status, value, detail) of the four checks; never fails.

    ``value`` is the number a check looked at: rows, rows, the worst null rate,
    duplicated keys. Without a table there are no rows.
    """
    schema = "table_name string, check string, status string, value double, detail string"
    if df is None:
        return SparkSession.active().createDataFrame([], schema)
    rate, col = _worst(cfg)
    facts = _facts(df, cfg)
    n, dups = F.col("n"), F.col("dup_keys")

    def row(check: str, bad: Column, level: str, value: Column, detail: Column) -> Column:
        return F.struct(
            F.lit(check).alias("check"),
            F.when(bad, level).otherwise("OK").alias("status"),
            value.cast("double").alias("value"),
            detail.cast("string").alias("detail"),
        )

    checks = F.array(
        row("freshness", n == 0, "CRITICAL", n, F.lit(None)),
        row("volume", n < cfg.min_rows, "CRITICAL", n, F.lit(None)),
        row("completeness", rate > cfg.max_null_rate, "WARNING", rate, col),
        row("consistency", dups > 0, "CRITICAL", dups, F.lit(cfg.primary_key)),
    )
    return facts.select(F.lit(cfg.name).alias("table_name"), F.inline(checks))


def check_freshness(df: DataFrame, name: str) -> DataFrame:
    """CRITICAL for an empty table."""
    return _one_check(df, name, F.count(F.lit(1)), lambda n: n == 0, "CRITICAL")


def check_volume(df: DataFrame, name: str, floor: int = MIN_ROW_COUNT) -> DataFrame:
    """CRITICAL below a number of rows."""
    return _one_check(df, name, F.count(F.lit(1)), lambda n: n < floor, "CRITICAL")


def check_sla(df: DataFrame, name: str, ts: str, hours: int, now: Column) -> DataFrame:
    """CRITICAL when the newest row is older than the allowed hours, or there is none."""
    age = (F.unix_timestamp(now.cast("timestamp")) - F.unix_timestamp(F.max(ts).cast("timestamp"))) / 3600
    return _one_check(df, name, age, lambda h: h.isNull() | (h > hours), "CRITICAL")


def check_completeness(
    df: DataFrame, name: str, cols: list[str], max_rate: float = MAX_NULL_RATE
) -> DataFrame:
    """WARNING when the worst column's share of NULLs is above the limit, in one pass."""
    cfg = TableChecks(name, cols[0], cols, max_rate)
    facts = df.agg(
        F.count(F.lit(1)).alias("n"), *[F.count_if(F.col(c).isNull()).alias(f"nulls_{c}") for c in cols]
    )
    rate, col = _worst(cfg)
    return facts.select(
        F.lit(name).alias("table_name"),
        F.when(rate > max_rate, "WARNING").otherwise("OK").alias("status"),
        rate.alias("value"),
        col.alias("worst_column"),
    )


def check_unique(df: DataFrame, name: str, keys: list[str]) -> DataFrame:
    """CRITICAL when a key repeats."""
    dups = count_duplicates(df, keys)
    return _one_check(dups, name, F.max("dup_keys"), lambda n: n > 0, "CRITICAL")


def _one_check(df: DataFrame, name: str, value: Column, bad, level: str) -> DataFrame:
    return df.agg(value.cast("double").alias("value")).select(
        F.lit(name).alias("table_name"),
        F.when(bad(F.col("value")), level).otherwise("OK").alias("status"),
        "value",
    )


def alerts(problems: DataFrame) -> DataFrame:
    """Alert rows from (ts, severity, table_name, message): where they go and whether they page."""
    return problems.select(
        "ts",
        "severity",
        channel("severity").alias("channel"),
        "table_name",
        "message",
        (F.col("severity") == "CRITICAL").alias("pages"),
    )


def severity_of(error: BaseException) -> str:
    """Severity of a failed run: a quality failure is critical, anything else is a warning."""
    return "CRITICAL" if isinstance(error, DataQualityError) else "WARNING"


def post_audit(df: DataFrame, cfg: TableChecks, alerts_path: str | None = None) -> None:
    """Stop the run when the primary key repeats; first leave a critical alert."""
    dups = count_duplicates(df, [cfg.primary_key]).first()["dup_keys"]
    if dups == 0:
        return
    message = f"{dups} values of {cfg.primary_key} occur more than once"
    if alerts_path:
        problem = one_row(df.sparkSession, severity="CRITICAL", table_name=cfg.name, message=message)
        problem = problem.withColumn("ts", F.current_timestamp())
        alerts(problem).write.mode("append").parquet(alerts_path)
    raise DataQualityError(f"{cfg.name}: {message}")


def table_health(
    alert_rows: DataFrame, tables: DataFrame, now: Column, seconds: int = PAGE_FRESH_SECONDS
) -> DataFrame:
    """QUARANTINED for tables paged within the last seconds before ``now``, else HEALTHY.

    Alerts are reduced to one flag per table before they meet the table list.
    """
    fresh = F.col("ts") >= now - F.expr(f"INTERVAL {int(seconds)} SECONDS")
    paged = alert_rows.filter(F.col("pages") & fresh).groupBy("table_name").agg(F.lit(True).alias("__hit"))
    return tables.select("table_name").distinct().join(paged, "table_name", "left").select(
        "table_name", F.when(F.col("__hit"), "QUARANTINED").otherwise("HEALTHY").alias("status")
    )


def audit_duplicates(
    embeddings: DataFrame,
    metadata: DataFrame,
    key: str = "screen_id",
    per_key: int = 2,
    embedding_keys: list[str] | None = None,
    run_id: str | None = None,
) -> DataFrame:
    """One audit row (run_id, audit_name, audit_status, details).

    Embeddings are audited by rows per key (more than ``per_key``), or, with
    ``embedding_keys``, by repeats of the whole key. ``details`` is JSON.
    """
    emb = over(embeddings, embedding_keys) if embedding_keys else over(embeddings, [key], per_key)
    meta = over(metadata, [key])
    counts = (
        emb.select(F.lit(1).alias("e"), F.lit(0).alias("m"))
        .unionByName(meta.select(F.lit(0).alias("e"), F.lit(1).alias("m")))
        .agg(
            F.coalesce(F.sum("e"), F.lit(0)).alias("duplicate_embeddings"),
            F.coalesce(F.sum("m"), F.lit(0)).alias("duplicate_metadata"),
        )
    )
    counts = staged_by_small_tasks(counts, "audit")
    bad = (F.col("duplicate_embeddings") > 0) | (F.col("duplicate_metadata") > 0)
    return counts.select(
        F.lit(run_id).cast("string").alias("run_id"),
        F.lit("duplicate_check").alias("audit_name"),
        F.when(bad, "failed").otherwise("passed").alias("audit_status"),
        F.to_json(F.struct("duplicate_embeddings", "duplicate_metadata")).alias("details"),
    )


def enforce_audit(audit: DataFrame, path: str | None = None) -> None:
    """Store an audit row, then stop the run if it failed."""
    row = audit.first()
    if path:
        stored = one_row(audit.sparkSession, **row.asDict()).withColumn("run_id", F.lit(row["run_id"]).cast("string"))
        stored.withColumn("created_at", F.current_timestamp()).write.mode("append").parquet(path)
    if row["audit_status"] != "passed":
        raise DataQualityError(f"{row['audit_name']}: {row['details']}")
