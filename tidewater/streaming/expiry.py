"""Deduplication by keyed state that expires, with late rows kept and marked.

``dropDuplicates`` behind a watermark loses rows that are later than the delay, also those of new keys. Here the
watermark follows the time of arrival, in which no row is late; how late a row is by its own time is a column of the result.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import LongType, StringType, StructField, StructType


# Keyed state with timers keeps several tables for one query, which Spark's default store does not.
STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
# Groups that the keys are dealt over.
BUCKETS = 1024


@contextmanager
def rocksdb_state(spark: SparkSession) -> Iterator[None]:
    """Streams started within keep their state in RocksDB, whatever the session is set to.

    A stream copies the session's settings when it starts, so that the session gets its own one back at the end.
    """
    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name)
    spark.conf.set(name, STATE_STORE)
    try:
        yield
    finally:
        spark.conf.set(name, before)


def _processor(keep_ms: int) -> StatefulProcessor:
    # A class made here is pickled whole, so that workers need not find this package.
    class FirstWithin(StatefulProcessor):
        """Per key of a bucket the arrival of the row that was passed on last, forgotten once it no longer matters."""

        def init(self, handle: StatefulProcessorHandle) -> None:
            self.handle = handle
            entry = StructType([StructField("key", StringType()), StructField("ms", LongType())])
            self.passed = handle.getListState("passed", entry)

        def hold(self, passed: dict[str, int], watermark: int) -> None:
            # A key that the watermark has left behind matters to no later row. One timer does for a bucket's others.
            held = [(key, ms) for key, ms in passed.items() if ms + keep_ms >= watermark]
            if held:
                self.passed.put(held)
                self.handle.registerTimer(max(ms for _, ms in held) + keep_ms + 1)
            else:
                self.passed.clear()

        def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
            passed = dict(self.passed.get())
            # Arrival decides, and a bucket's rows may come in several frames in any order.
            frame = pd.concat(list(rows), ignore_index=True).sort_values("ms", kind="stable")
            kept = []
            for of, ms in zip(frame["key"].tolist(), frame["ms"].tolist()):
                last = passed.get(of)
                kept.append(last is None or ms - last > keep_ms)
                if kept[-1]:
                    passed[of] = ms
            yield frame[kept].drop(columns=["bucket", "key", "ms"])
            self.hold(passed, timerValues.getCurrentWatermarkInMs())

        def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
            self.hold(dict(self.passed.get()), timerValues.getCurrentWatermarkInMs())
            return iter(())

        def close(self) -> None:
            pass

    return FirstWithin()


def _key(rows: DataFrame, keys: list[str]) -> Column:
    """The key as text: NULL is a value, and zeros and times are told apart as by a grouping."""
    kinds = dict(rows.dtypes)
    parts = [F.col(f"`{k}`") + F.lit(0).cast(kinds[k]) if kinds[k] in ("float", "double") else F.col(f"`{k}`") for k in keys]
    whole = F.struct(*[part.alias(f"k{i}") for i, part in enumerate(parts)])
    times = {"timestampFormat": "yyyy-MM-dd HH:mm:ss.SSSSSS", "timestampNTZFormat": "yyyy-MM-dd HH:mm:ss.SSSSSS", "timeZone": "UTC"}
    return F.to_json(whole, times)


def first_within(
    rows: DataFrame, keys: list[str], ts: str, arrived: str, delay: str, keep_seconds: int, buckets: int = BUCKETS
) -> DataFrame:
    """The rows of a stream without copies of their key, and whether each is late (``late``).

    A row is passed on unless one of its key was passed on at most ``keep_seconds`` before it, by ``arrived``, the time
    at which the log took the record. It is late when it arrived more than ``delay`` (an interval such as
    ``2 hours``) after its own time ``ts``; late rows are not dropped, and rows without a time ``ts`` are not late. Rows without an
    arrival time cannot be placed and are refused (the query fails). The state holds a number for
    each key of the last ``keep_seconds``. Keys are dealt over ``buckets``, so that Python and the state store are asked once
    for many keys; a bucket's state and its rows of one micro-batch are held in one task, where these are put in order of arrival. The
    source's limit of a micro-batch (files or offsets per trigger) and the number of buckets bound them. For keys with very many copies put
    :func:`tidewater.streaming.dedup_stream` with a salt before. Start the stream in a session whose state store is RocksDB, or
    within :func:`rocksdb_state`.
    """
    late = F.coalesce(F.col(arrived) > F.col(ts) + F.expr(f"interval {delay}"), F.lit(False))
    ms = F.coalesce(F.unix_millis(arrived), F.raise_error(F.lit(f"a row has no {arrived}")).cast("bigint"))
    # The processor's frames do not keep every name (an underscore in front is lost), so columns go by number.
    numbers = {c: f"c{i}" for i, c in enumerate(rows.columns)}
    key = _key(rows, keys)
    numbered = rows.withWatermark(arrived, "0 seconds").select(
        *[F.col(f"`{c}`").alias(n) for c, n in numbers.items()],
        late.alias("late"), ms.alias("ms"), key.alias("key"), F.pmod(F.xxhash64(key), F.lit(buckets)).alias("bucket"),
    )
    found = numbered.groupBy("bucket").transformWithStateInPandas(
        statefulProcessor=_processor(keep_seconds * 1000), outputStructType=numbered.drop("ms", "key", "bucket").schema,
        outputMode="append", timeMode="eventTime",
    )
    return found.select(*[F.col(n).alias(c) for c, n in numbers.items()], "late")
