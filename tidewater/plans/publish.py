"""Write aside, audit, publish: readers of a table never see a batch that failed its checks.

The rows are written to a staging folder first. Their number and the NULLs of critical columns are counted by the writing
pass itself; repeated keys take one aggregate over what was written. A CRITICAL finding leaves an alert and
raises before anything of the table has changed; a WARNING leaves an alert and goes on.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from tidewater.errors import DataQualityError
from tidewater.operators.dedup import count_duplicates
from tidewater.operators.quality import TableChecks, alerts
from tidewater.session import fresh_path, observed, one_row
from tidewater.sinks import overwrite, overwrite_partitions


def findings(cfg: TableChecks, n: int, nulls: dict[str, int], dup_keys: int) -> list[tuple[str, str]]:
    """(severity, message) of every check that does not hold."""
    out = []
    if n < cfg.min_rows:
        out.append(("CRITICAL", f"{n} rows, at least {cfg.min_rows} are expected"))
    if dup_keys:
        out.append(("CRITICAL", f"{dup_keys} values of {cfg.primary_key} occur more than once"))
    for column, count in nulls.items():
        if n and count / n > cfg.max_null_rate:
            out.append(("WARNING", f"{count} of {n} rows have no {column}"))
    return out


def write_audited(
    df: DataFrame, cfg: TableChecks, path: str, alerts_path: str | None = None,
    columns: tuple[str, ...] = (),
) -> None:
    """Write rows to a path that nothing reads yet, and raise if they fail their checks."""
    seen = Observation()
    nulls = [F.count_if(F.col(c).isNull()).alias(f"nulls_{c}") for c in cfg.critical_columns]
    counted = df.observe(seen, F.count(F.lit(1)).alias("n"), *nulls)
    writer = counted.write.mode("overwrite")
    (writer.partitionBy(*columns) if columns else writer).parquet(path)
    facts = observed(seen, n=0, **{f"nulls_{c}": 0 for c in cfg.critical_columns})
    spark = df.sparkSession
    written = spark.read.schema(df.schema).parquet(path)
    dup_keys = count_duplicates(written, [cfg.primary_key]).first()["dup_keys"]
    found = findings(cfg, facts["n"], {c: facts[f"nulls_{c}"] for c in cfg.critical_columns}, dup_keys)
    if alerts_path:
        for severity, message in found:
            problem = one_row(spark, severity=severity, table_name=cfg.name, message=message)
            alerts(problem.withColumn("ts", F.current_timestamp())).write.mode("append").parquet(alerts_path)
    critical = [message for severity, message in found if severity == "CRITICAL"]
    if critical:
        raise DataQualityError(f"{cfg.name}: {'; '.join(critical)}")


def publish(
    df: DataFrame, path: str, cfg: TableChecks, alerts_path: str | None = None, columns: tuple[str, ...] = ()
) -> None:
    """Replace a table, or with ``columns`` the partitions that the rows belong to, if the rows pass their checks."""
    aside = fresh_path(df.sparkSession, "unpublished")
    write_audited(df, cfg, aside, alerts_path)
    rows = df.sparkSession.read.schema(df.schema).parquet(aside)
    if columns:
        overwrite_partitions(rows, path, *columns)
    else:
        overwrite(rows, path)


def gate(cfg: TableChecks, alerts_path: str | None = None) -> Callable[[DataFrame, str], None]:
    """A writer for :func:`tidewater.operators.history.stateful_merge`, which commits what it wrote only afterwards."""

    def write(state: DataFrame, path: str) -> None:
        write_audited(state, cfg, path, alerts_path)

    return write
