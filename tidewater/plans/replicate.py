"""Replication of one configured table: pre-audit, merge, post-audit."""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from tidewater.operators.history import (
    current_snapshot_id,
    state_at,
    state_at_changes,
    stateful_merge,
    stateful_merge_changes,
    stateful_merge_table,
)
from tidewater.operators.quality import TableChecks, post_audit, pre_audit
from tidewater.plans.publish import gate
from tidewater.sources import read_csv_dir


@dataclass(frozen=True)
class Replication:
    """What to replicate, and into what.

    ``mode`` says how a run is stored: ``batches`` writes the batch of each run only, ``states``
    the whole table per run, for small tables that are read often, both below the folder ``root``;
    ``table`` merges into the Iceberg table that ``root`` names.
    """

    name: str
    primary_key: str
    source_path: str
    root: str
    ledger_path: str
    critical_columns: list[str] = field(default_factory=list)
    alerts_path: str | None = None
    schema: StructType | str | None = None
    mode: str = "states"

    @property
    def checks(self) -> TableChecks:
        return TableChecks(self.name, self.primary_key, self.critical_columns)


def replicate(spark: SparkSession, cfg: Replication, run_date: date) -> tuple[DataFrame, int]:
    """One run. Returns the pre-audit rows and the new snapshot id.

    The pre-audit only reports. The post-audit raises when the merged table has
    repeated keys, after it left an alert. With whole states it stands before the commit, so that readers and the ledger
    never come to a state that failed; the other modes audit what has been merged.
    """
    source = read_csv_dir(spark, cfg.source_path, cfg.schema)
    keys = [cfg.primary_key]
    if cfg.mode == "table":
        now = spark.table(cfg.root) if spark.catalog.tableExists(cfg.root) else None
        before = pre_audit(now, cfg.checks)
        made = stateful_merge_table(spark, cfg.root, source, keys, run_date, cfg.ledger_path)
        post_audit(spark.table(cfg.root), cfg.checks, cfg.alerts_path)
        return before, made
    now = current_snapshot_id(spark, cfg.root)
    before = pre_audit(None if now is None else replica(spark, cfg, now), cfg.checks)
    if cfg.mode == "states":
        audited = gate(cfg.checks, cfg.alerts_path)
        made = stateful_merge(spark, cfg.root, source, keys, cfg.name, run_date, cfg.ledger_path, audited)
        return before, made
    made = stateful_merge_changes(spark, cfg.root, source, keys, cfg.name, run_date, cfg.ledger_path)
    post_audit(replica(spark, cfg, made), cfg.checks, cfg.alerts_path)
    return before, made


def replica(spark: SparkSession, cfg: Replication, snapshot_id: int) -> DataFrame:
    """The replicated table as of a snapshot below ``root``."""
    if cfg.mode == "batches":
        return state_at_changes(spark, cfg.root, [cfg.primary_key], snapshot_id)
    return state_at(spark, cfg.root, snapshot_id)
