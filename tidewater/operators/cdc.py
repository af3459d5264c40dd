"""Change-data capture: envelope parsing, collapse to the latest event, reconciliation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidewater.errors import ReconcileError
from tidewater.functions import computed_once, fingerprint
from tidewater.operators.dedup import latest_per_key


def _envelope(image: str) -> str:
    body = f"op:string,before:{image},after:{image},source:struct<lsn:string,table:string>,ts_ms:string"
    return f"struct<payload:struct<{body}>,{body}>"


def drop_tombstones(df: DataFrame, value: str = "value") -> DataFrame:
    """Records with a payload. A NULL payload only tells the log to forget a key."""
    return df.filter(F.col(value).isNotNull())


def parse_cdc(records: DataFrame, fields: dict[str, str], value: str = "value") -> DataFrame:
    """Change events as flat columns: op, before_*, after_*, source_table, source_lsn, ts_ms.

    ``fields`` maps the row's columns to types. The envelope may or may not be
    wrapped in ``payload``. It is parsed once per record, with text leaves; a leaf
    that does not fit its type becomes NULL. Tombstones are dropped, the other
    columns of the record are kept.
    """
    image = "struct<" + ",".join(f"{name}:string" for name in fields) + ">"
    keep = [c for c in records.columns if c != value]
    envelope = F.from_json(F.col(value).cast("string"), _envelope(image))
    parsed = computed_once(drop_tombstones(records, value), keep, "__e", envelope)

    def leaf(path: str) -> Column:
        return F.coalesce(F.col(f"__e.payload.{path}"), F.col(f"__e.{path}"))

    return parsed.select(
        *keep,
        leaf("op").alias("op"),
        *[leaf(f"before.{n}").try_cast(t).alias(f"before_{n}") for n, t in fields.items()],
        *[leaf(f"after.{n}").try_cast(t).alias(f"after_{n}") for n, t in fields.items()],
        leaf("source.table").alias("source_table"),
        leaf("source.lsn").try_cast("bigint").alias("source_lsn"),
        leaf("ts_ms").try_cast("bigint").alias("ts_ms"),
    )


def for_table(events: DataFrame, table: str) -> DataFrame:
    """The events of one source table. Ids of different tables may be equal, so each has its own mirror."""
    return events.filter(F.col("source_table") == table)


def parse_cdc_nested(records: DataFrame, image: str | StructType, value: str = "value") -> DataFrame:
    """Change events with the before and after images as structs of a declared type."""
    kind = image.simpleString() if isinstance(image, StructType) else image
    envelope = F.from_json(F.col(value).cast("string"), _envelope(kind))
    keep = [c for c in records.columns if c != value]
    parsed = computed_once(drop_tombstones(records, value), keep, "__e", envelope)

    def leaf(path: str) -> Column:
        return F.coalesce(F.col(f"__e.payload.{path}"), F.col(f"__e.{path}"))

    return parsed.select(
        *keep,
        leaf("op").alias("op"),
        leaf("before").alias("before"),
        leaf("after").alias("after"),
        leaf("ts_ms").try_cast("bigint").alias("ts_ms"),
        leaf("source.table").alias("table"),
    )


def infer_payload_schema(records: DataFrame, value: str = "value") -> str:
    """The JSON type of all payloads together, as Spark SQL type text.

    The types of every record are merged by an aggregate, so a first record
    without an after image does not hide columns.
    """
    parsed = drop_tombstones(records, value).select(
        F.try_parse_json(F.col(value).cast("string")).alias("v")
    )
    return parsed.agg(F.schema_of_variant_agg("v").alias("s")).first()["s"]


def with_entity_key(events: DataFrame, key: str = "id", name: str = "entity_id") -> DataFrame:
    """The row's key: of the after image, or of the before image when the row was deleted."""
    return events.withColumn(name, F.coalesce(f"after_{key}", f"before_{key}"))


def latest_changes(
    events: DataFrame, keys: list[str] | None = None, order: tuple[str, ...] = ("ts_ms", "source_lsn")
) -> DataFrame:
    """The newest event per key, ties on time going to the later log position."""
    return latest_per_key(events.filter(F.col("op").isNotNull()), keys or ["entity_id"], list(order))


def unreadable(events: DataFrame) -> DataFrame:
    """Parsed records without a kind of change: what :func:`latest_changes` leaves out."""
    return events.filter(F.col("op").isNull())


def new_events(
    bronze: DataFrame, batch: DataFrame, at: tuple[str, ...] = ("topic", "partition", "offset")
) -> DataFrame:
    """Records of a batch that bronze does not hold yet, by their place in the log.

    ``at`` ends with the offset, which rises within the columns before it. Only what bronze
    holds from the batch's lowest offsets on is compared: one small row per partition of the log.
    """
    *log, offset = at
    lowest = batch.groupBy(*log).agg(F.min(offset).alias("__from"))
    recent = bronze.select(*at).join(lowest, log).filter(F.col(offset) >= F.col("__from")).drop("__from")
    return batch.join(recent, list(at), "left_anti")


def op_counts(events: DataFrame) -> DataFrame:
    """Events per kind of change."""
    return events.groupBy("op").agg(F.count(F.lit(1)).alias("n"))


def reconcile(source: DataFrame, mirror: DataFrame) -> DataFrame:
    """One row: source_n, mirror_n and whether they match."""
    sides = source.agg(F.count(F.lit(1)).alias("source_n")).withColumn("mirror_n", F.lit(0).cast("bigint"))
    other = mirror.agg(F.count(F.lit(1)).alias("mirror_n")).withColumn("source_n", F.lit(0).cast("bigint"))
    return (
        sides.unionByName(other)
        .agg(F.sum("source_n").alias("source_n"), F.sum("mirror_n").alias("mirror_n"))
        .withColumn("matches", F.col("source_n") == F.col("mirror_n"))
    )


def reconcile_rows(source: DataFrame, mirror: DataFrame, keys: list[str], values: list[str]) -> DataFrame:
    """Keys on which source and mirror differ, as missing, extra or changed.

    Both sides are hashed and stacked, then compared in one aggregate per key.
    Rows are compared by value counts, so repeated keys are compared whole.
    """

    def side(df: DataFrame, sign: int) -> DataFrame:
        digest = F.struct(*[F.col(v).cast("string").alias(v) for v in values])
        return df.select(*keys, fingerprint(F.to_json(digest)).alias("h"), F.lit(sign).alias("d"))

    per_value = (
        side(source, 1)
        .unionByName(side(mirror, -1))
        .groupBy(*keys, "h")
        .agg(F.sum("d").alias("d"))
        .filter("d <> 0")
    )
    return per_value.groupBy(*keys).agg(
        F.when(F.min("d") > 0, "missing").when(F.max("d") < 0, "extra").otherwise("changed").alias("diff")
    )


def assert_reconciled(source: DataFrame, mirror: DataFrame) -> None:
    """Fail when source and mirror differ in their number of rows."""
    row = reconcile(source, mirror).first()
    if not row["matches"]:
        raise ReconcileError(f"source has {row['source_n']} rows, mirror has {row['mirror_n']}")
