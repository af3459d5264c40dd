r"""Line dedup over levelled sorted runs of line hashes. DataFrame functions only.

A line's key is the line without white space (``[\x20\x09-\x0D]``) at its ends and with A-Z in
lower case; keys shorter than ``min_chars`` are never touched. A run is a bucketed table of
(128-bit key hash, number of documents, largest doc_id), sorted by hash within each bucket.
A batch of documents adds a run of its own at level 0; when a level has ``fanout`` runs,
they are merged into one run of the next level, so n batches leave about log(n) runs
and each row is rewritten about log(n) times.

``LineRuns.add`` takes a batch that is new; ``LineRuns.drop`` merge-anti-joins lines with the
runs: a line goes when its key is known from ``min_docs`` documents and from a larger doc_id. An
incoming batch may so be judged against all earlier ones (``dedup_batch``), and a whole
table by adding all its batches first (``dedup_table``), where each key that is found in
``min_docs`` documents keeps its lines in the document of the largest id alone.

Hot lines are one row per document in a task before any shuffle, and one row per task
after partial aggregation. Documents meet their decisions by doc_id, never by line.

Null and empty texts are one empty line and stay empty. Rows of equal doc_id are one
document for counting, and each row keeps its own text; a null doc_id counts as a
document below all others. Extra columns are carried, whatever their names. An empty
table stays empty.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.llm.staging import staged
from tidewater.session import drop_path, fresh_path

SPACE = "\x20\x09\x0a\x0b\x0c\x0d"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

MIN_CHARS = 40
MIN_DOCS = 5
BATCHES = 4
FANOUT = 2


def line_key(line: Column) -> Column:
    return F.translate(F.btrim(line, F.lit(SPACE)), UPPER, LOWER)


def long_keys(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_chars: int = MIN_CHARS) -> DataFrame:
    """A row per long line: doc_id, a hash of its text, position of the line, and the hash (h1, h2) of its key."""
    # Lines too short before they are trimmed are left out before anything is computed for them.
    whole = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(
        F.col(doc_id).alias("doc_id"),
        F.xxhash64(whole).alias("row"),
        F.posexplode(F.split(whole, "\n", -1)).alias("pos", "line"),
    )
    rows = rows.where(F.length("line") >= min_chars)
    rows = rows.select("doc_id", "row", "pos", line_key(F.col("line")).alias("key"))
    rows = rows.where(F.length("key") >= min_chars)
    return rows.select(
        "doc_id", "row", "pos", F.xxhash64("key").alias("h1"), F.xxhash64(F.lit("second"), "key").alias("h2")
    )


class LineRuns:
    """Levelled sorted runs: tables of the session whose files lie in the shared folder."""

    def __init__(self, spark: SparkSession, fanout: int = FANOUT, buckets: int | None = None):
        self.spark, self.fanout = spark, fanout
        # As many as a shuffle has partitions, so that a run is laid out as what it meets.
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.name = f"line_runs_{uuid.uuid4().hex[:12]}"
        self.paths: dict[str, str] = {}
        self.levels: list[list[str]] = []

    def _write(self, rows: DataFrame) -> str:
        """Rows that are already dealt out by hash, as a run: one sorted file per bucket."""
        table = f"{self.name}_{len(self.paths)}"
        self.paths[table] = fresh_path(self.spark, "line-run")
        write = rows.write.format("parquet").bucketBy(self.buckets, "h1", "h2").sortBy("h1", "h2")
        write.option("path", self.paths[table]).saveAsTable(table)
        return table

    def _merged(self, tables: list[str]) -> DataFrame:
        """Runs merged pairwise. Their buckets lie side by side, so that nothing is shuffled."""
        rows = self.spark.table(tables[0])
        for table in tables[1:]:
            other = self.spark.table(table)
            other = other.select("h1", "h2", F.col("n_docs").alias("more"), F.col("max_doc").alias("other"))
            rows = rows.join(other.hint("merge"), ["h1", "h2"], "full").select(
                "h1",
                "h2",
                (F.coalesce("n_docs", F.lit(0)) + F.coalesce("more", F.lit(0))).alias("n_docs"),
                F.greatest("max_doc", "other").alias("max_doc"),
            )
        return rows

    def add(self, keys: DataFrame) -> None:
        """Add the keys of a batch, as ``long_keys`` gives them, of documents that are in no other batch."""
        once = keys.select("h1", "h2", "doc_id").distinct()
        rows = once.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("n_docs"), F.max("doc_id").alias("max_doc"))
        self._place(self._write(rows.repartition(self.buckets, "h1", "h2")), 0)

    def _place(self, table: str, level: int) -> None:
        if level == len(self.levels):
            self.levels.append([])
        self.levels[level].append(table)
        if len(self.levels[level]) == self.fanout:
            runs, self.levels[level] = self.levels[level], []
            merged = self._write(self._merged(runs))
            self._forget(runs)
            self._place(merged, level + 1)

    def compact(self) -> str | None:
        """Merge all runs into one."""
        runs = [table for level in self.levels for table in level]
        if len(runs) > 1:
            merged = self._write(self._merged(runs))
            self._forget(runs)
            self.levels = [[] for _ in self.levels] + [[merged]]
            return merged
        return runs[0] if runs else None

    def _forget(self, tables: list[str]) -> None:
        for table in tables:
            self.spark.sql(f"drop table if exists {table}")
            drop_path(self.spark, self.paths[table])

    def close(self) -> None:
        """Remove all runs, also those that a step which failed has left."""
        self._forget(list(self.paths))
        self.levels = []

    def known(self, min_docs: int = MIN_DOCS) -> DataFrame:
        """Keys found in enough documents, and the largest of these."""
        run = self.compact()
        if run is None:
            return self.spark.createDataFrame([], "h1 long, h2 long, n_docs long, max_doc long")
        return self.spark.table(run).where(F.col("n_docs") >= min_docs)

    def drop(self, keys: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
        """The rows of ``keys`` whose lines go: the merge join with the runs finds their key in a larger document."""
        known = self.known(min_docs).select(F.col("h1").alias("run_h1"), F.col("h2").alias("run_h2"), "max_doc")
        # Written without buckets, so that both sides are shuffled for the merge and Spark can split a hot line.
        known = staged(known, "line-known")
        later = F.col("doc_id").isNull() | (F.col("doc_id") < F.col("max_doc"))
        same = (F.col("h1") == F.col("run_h1")) & (F.col("h2") == F.col("run_h2"))
        return keys.join(known.hint("merge"), same & F.col("max_doc").isNotNull() & later, "left_semi")


def without(docs: DataFrame, gone: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Documents without the lines in ``gone`` (doc_id, row, pos).

    Column ``line_stats`` (n_lines before, n_dropped) is added; it takes the place of one of that name.
    """
    gone = gone.groupBy("doc_id", "row").agg(F.array_sort(F.collect_set("pos")).alias("gone"))
    gone = gone.select(F.col("doc_id").alias("gone_doc"), F.col("row").alias("gone_row"), "gone")
    # The table's own columns are held in a struct, so that no name of theirs meets one of these.
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"))
    whole = F.coalesce(F.col("doc")[text], F.lit(""))
    same = F.col("doc")[doc_id].eqNullSafe(F.col("gone_doc")) & (F.xxhash64(whole) == F.col("gone_row"))
    cut = rows.join(gone, same, "left").select(
        "doc", F.split(whole, "\n", -1).alias("lines"), F.coalesce("gone", F.array().cast("array<int>")).alias("gone")
    )
    # The lines between two dropped ones are slices, so the work is in proportion to lines plus drops.
    kept = F.expr(
        """
        array_join(flatten(transform(sequence(0, size(gone)), i ->
          slice(lines,
            if(i = 0, 0, gone[greatest(i - 1, 0)] + 1) + 1,
            if(i = size(gone), size(lines), gone[least(i, size(gone) - 1)])
              - if(i = 0, 0, gone[greatest(i - 1, 0)] + 1)))), '\\n')
        """
    )
    stats = F.struct(F.size("lines").cast("long").alias("n_lines"), F.size("gone").cast("long").alias("n_dropped"))
    cut = cut.select("doc", stats.alias("stats"), F.when(F.size("gone") == 0, whole).otherwise(kept).alias("kept"))
    own = [F.col("kept").alias(c) if c == text else F.col("doc")[c].alias(c) for c in docs.columns if c != "line_stats"]
    return cut.select(*own, F.col("stats").alias("line_stats"))


def _batches(keys: DataFrame, batches: int) -> tuple[DataFrame, list[DataFrame]]:
    """The keys written once, whole and by batch: all rows of a document are in one batch, and each row is in one."""
    spark = keys.sparkSession
    batch = F.pmod(F.xxhash64("doc_id"), F.lit(batches)).cast("int")
    path = fresh_path(spark, "line-batches")
    keys.select("h1", "h2", "doc_id", "row", "pos", batch.alias("batch")).write.partitionBy("batch").parquet(path)
    written = spark.read.schema("h1 long, h2 long, doc_id long, row long, pos int, batch int").parquet(path)
    return written.drop("batch"), [written.where(F.col("batch") == i).drop("batch") for i in range(batches)]


def dedup_table(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    min_chars: int = MIN_CHARS,
    min_docs: int = MIN_DOCS,
    batches: int = BATCHES,
) -> DataFrame:
    """A whole table, batch by batch into the runs, then judged against all of them."""
    runs = LineRuns(docs.sparkSession)
    try:
        keys, parts = _batches(long_keys(docs, doc_id, text, min_chars), batches)
        for part in parts:
            runs.add(part)
        gone = staged(runs.drop(keys, min_docs).select("doc_id", "row", "pos"), "line-drops")
    finally:
        runs.close()
    return without(docs, gone, doc_id, text)


def dedup_batch(
    runs: LineRuns, docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_chars: int = MIN_CHARS, min_docs: int = 1
) -> DataFrame:
    """A batch judged against earlier ones, whatever their ids, and then added to the runs.

    Its lines whose key ``min_docs`` earlier documents hold are dropped. The batch's keys are added as they came.
    """
    keys = staged(long_keys(docs, doc_id, text, min_chars), "line-keys")
    known = runs.known(min_docs).select(F.col("h1").alias("run_h1"), F.col("h2").alias("run_h2"))
    same = (F.col("h1") == F.col("run_h1")) & (F.col("h2") == F.col("run_h2"))
    new = keys.join(known.hint("merge"), same, "left_anti")
    at = ["doc_id", "row", "pos"]
    gone = staged(keys.join(new.select(*at), at, "left_anti").select(*at), "line-drops")
    runs.add(keys)
    return without(docs, gone, doc_id, text)
