"""Helpers for Arrow columns inside tasks."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import SparkSession

# Rows that go to a Python worker at once. Texts of 100 KB and more are common, so
# Spark's default of 10,000 rows would be a gigabyte.
BATCH_ROWS = 1000
BATCH_BYTES = 16 << 20


def prepare_session(spark: SparkSession) -> None:
    """Bound the session's Arrow batches by rows and bytes."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def list_of(offsets: np.ndarray, values: pa.Array, valid: np.ndarray | None = None) -> pa.Array:
    """A list column from offsets; rows that are not valid become null."""
    offsets = pa.array(offsets.astype(np.int32), pa.int32())
    mask = None if valid is None else pa.array(~valid)
    return pa.ListArray.from_arrays(offsets, values, mask=mask)


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The numbers start, start + 1, ... for each start, one after another."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return np.arange(total) + np.repeat(starts - (ends - lengths), lengths)
