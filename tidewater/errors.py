"""Errors raised by gates and by operators that refuse ambiguous input."""

from __future__ import annotations


class DataQualityError(Exception):
    """A quality gate found a table that must not reach its consumers."""


class ReconcileError(Exception):
    """A mirror does not match its source."""
