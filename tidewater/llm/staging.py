"""Staging whose shuffles are dropped once the write behind them is done."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tidewater import session

_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def staged(df: DataFrame, label: str = "stage", **options: str) -> DataFrame:
    """As :func:`tidewater.session.staged`; the shuffle files of this write go when it ends.

    While it runs lost executors are made good as ever. The setting holds for the write
    alone: a DataFrame that a caller gets may be run more than once.
    """
    conf = df.sparkSession.conf
    before = conf.get(_CLEANUP)
    conf.set(_CLEANUP, "true")
    try:
        return session.staged(df.select("*"), label, **options)
    finally:
        conf.set(_CLEANUP, before)


def drop(df: DataFrame) -> None:
    """Remove what :func:`staged` wrote for a DataFrame that nothing will read again."""
    folders = {f.rsplit("/", 1)[0] for f in df.inputFiles()}
    for folder in folders:
        session.drop_path(df.sparkSession, folder)
