"""Registered queries over the given tables."""

from tidewater.workloads import batch, changes, corpus, reliability, streams, tables  # noqa: F401
from tidewater.workloads.registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
