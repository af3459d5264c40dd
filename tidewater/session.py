"""Session settings, and the shared folder that holds checkpoints and staged tables."""

from __future__ import annotations

import tempfile
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

# Settings the operators are written for. Shuffle partitions are left to the
# cluster: AQE coalesces from whatever start value it is given.
CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
}

_LOCAL_DIRS: dict[str, str] = {}


def build_session(app: str = "tidewater", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings above; keyword ``a__b`` sets ``a.b``."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**CONF, **{k.replace("__", "."): v for k, v in conf.items()}}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.

    Executors read what the driver staged there, so a cluster has to name one.
    Only a local session without the setting gets a temporary folder.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors can reach")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL_DIRS:
        _LOCAL_DIRS[app] = tempfile.mkdtemp(prefix="tidewater-")
    return _LOCAL_DIRS[app]


def application_dir(spark: SparkSession) -> str:
    """What this application has staged lies under this folder."""
    return f"{shared_dir(spark)}/tidewater/{spark.sparkContext.applicationId}"


def fresh_path(spark: SparkSession, label: str) -> str:
    """A path under the shared folder that nothing has written to yet."""
    return f"{application_dir(spark)}/{label}-{uuid.uuid4().hex}"


def drop_path(spark: SparkSession, folder: str) -> None:
    """Remove a folder that this application wrote."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def drop_staged(spark: SparkSession) -> None:
    """Remove all that this application has staged. For its end: DataFrames may still read from there."""
    drop_path(spark, application_dir(spark))


def staged(df: DataFrame, label: str = "stage", **options: str) -> DataFrame:
    """The rows written once to the shared folder and read from there.

    For a result that several branches of a plan read: it is computed once, its
    size is known to the planner, and a lost executor does not bring back the work
    that led to it. The options are those of the Parquet writer.
    """
    path = fresh_path(df.sparkSession, label)
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


# Scans and shuffles in pieces of this size; more of them where the input is larger.
_SMALL = "16m"
_SMALL_TASKS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "512",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": _SMALL,
    "spark.sql.files.maxPartitionBytes": _SMALL,
}


def staged_by_small_tasks(df: DataFrame, label: str = "stage") -> DataFrame:
    """As :func:`staged`, by tasks whose size does not grow with the input.

    For aggregates with about as many groups as rows: a task holds the groups of its piece of the scan or
    shuffle. The settings hold for this write alone.
    """
    conf = df.sparkSession.conf
    before = {key: conf.get(key, None) for key in _SMALL_TASKS}
    try:
        for key, value in _SMALL_TASKS.items():
            conf.set(key, value)
        return staged(df.select("*"), label)
    finally:
        for key, value in before.items():
            conf.unset(key) if value is None else conf.set(key, value)


def observed(seen: Observation, **none) -> dict:
    """What a finished write observed; ``none`` if Spark found that there were no rows and left the metrics out."""
    try:
        return seen.get
    except Py4JJavaError:
        return none


def one_row(spark: SparkSession, **values) -> DataFrame:
    """One row of literals, in one partition and without a trip through Python."""
    return spark.range(0, 1, 1, 1).select(*[F.lit(v).alias(k) for k, v in values.items()])
