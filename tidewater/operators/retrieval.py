"""A retrieval index of lists around centroids: search by cosine in a few lists, or exactly.

The centroids are fitted on a bounded sample (``sample`` rows, by the hash of their id). Every
vector is assigned to the list of its nearest centroid and written to that list's partition. A
query is compared with the vectors of the ``probes`` lists whose centroids are nearest to it, exactly. Each list is
cut into blocks and meets the queries that probe it in bounded groups, so a list with a third of all vectors is many
groups, and the candidates of a query are the sizes of its lists.

How many lists a recall needs depends on the vectors: :func:`probes_for` measures it on the sample. For
whole results :func:`search_exact` goes on into every list that can still hold a nearer vector, by the largest
angle between the list's centroid and a vector in it.

Vectors that are null, hold a null or a non-finite entry, or are all zero have no direction and are left out on either side.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewater.operators.corpus import CORPUS_BLOCK, NEAREST_SCHEMA, QUERY_BLOCK, SIMILARITY_DIGITS, block_search
from tidewater.session import staged

# Sample rows for each list that is fitted, and in all.
SAMPLE_PER_LIST = 64
SAMPLE_MOST = 100_000
# Queries that probes_for takes from the sample.
TRIAL_QUERIES = 256
FIT_ROUNDS = 12


@dataclass(frozen=True)
class Index:
    """Where the lists are, their centroids (unit rows), sizes and widest angles."""

    path: str
    centroids: np.ndarray
    sizes: np.ndarray
    angles: np.ndarray


def has_direction(vector: str = "embedding") -> Column:
    """Whether a vector can be compared by cosine."""
    finite = F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c.cast("double")) < float("inf")))
    return F.coalesce(finite & F.exists(vector, lambda c: c != 0), F.lit(False))


def _unit(column: pa.Array) -> np.ndarray:
    rows = np.asarray(column.flatten()).astype("float64").reshape(len(column), -1) if len(column) else np.zeros((0, 1))
    return rows / np.maximum(np.linalg.norm(rows, axis=1, keepdims=True), 1e-300)


def sample_of(corpus: DataFrame, rows: int) -> np.ndarray:
    """Unit vectors of the rows with the smallest hashes of their id; the bound is ``rows``."""
    kept = corpus.filter(has_direction()).orderBy(F.xxhash64("corpus_id"), "corpus_id").limit(rows)
    table = kept.select("embedding").toArrow()
    return _unit(table.column("embedding").combine_chunks())


def fit_centroids(sample: np.ndarray, lists: int, rounds: int = FIT_ROUNDS) -> np.ndarray:
    """Spherical k-means: centroids as unit rows, begun far from each other."""
    if not len(sample):
        return np.zeros((0, sample.shape[1]))
    lists = min(lists, len(sample))
    chosen = [0]
    nearest = sample @ sample[0]
    for _ in range(lists - 1):
        chosen.append(int(np.argmin(nearest)))
        nearest = np.maximum(nearest, sample @ sample[chosen[-1]])
    centroids = sample[chosen]
    for _ in range(rounds):
        of = np.argmax(sample @ centroids.T, axis=1)
        sums = np.zeros_like(centroids)
        np.add.at(sums, of, sample)
        length = np.linalg.norm(sums, axis=1, keepdims=True)
        centroids = np.where(length > 0, sums / np.maximum(length, 1e-300), centroids)
    return centroids


def probes_for(sample: np.ndarray, centroids: np.ndarray, k: int, recall: float) -> int:
    """The least number of probed lists that finds this share of the k nearest within the sample.

    Neighbours within a sample are farther than those in the whole corpus, so this errs towards
    more lists.
    """
    lists = np.argsort(-(sample @ centroids.T), axis=1, kind="stable")
    own = lists[:, 0]
    rank = np.empty(len(centroids), int)
    places = []
    for i in range(min(TRIAL_QUERIES, len(sample))):
        sims = sample @ sample[i]
        sims[i] = -np.inf
        rank[lists[i]] = np.arange(len(centroids))
        places.extend(rank[own[np.argsort(-sims, kind="stable")[: min(k, len(sample) - 1)]]])
    if not places:
        return len(centroids)
    return int(np.sort(places)[int(np.ceil(recall * len(places))) - 1]) + 1


def _nearest_lists(centroids: np.ndarray, probes: int) -> Callable[[Column], Column]:
    """Column function: the lists of the nearest centroids, nearest first, with the angle to each."""

    def lists(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for vectors in batches:
            sims = np.clip(_unit(vectors) @ centroids.T, -1, 1)
            order = np.argsort(-sims, axis=1, kind="stable")[:, :probes]
            angles = np.arccos(np.take_along_axis(sims, order, axis=1))
            pairs = pa.StructArray.from_arrays(
                [pa.array(order.ravel().astype(np.int32)), pa.array(angles.ravel())], ["list", "angle"]
            )
            yield pa.ListArray.from_arrays(pa.array(np.arange(len(vectors) + 1, dtype=np.int32) * order.shape[1]), pairs)

    lists.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return F.arrow_udf(lists, "array<struct<list:int,angle:double>>")


def build_index(corpus: DataFrame, path: str, lists: int, sample: int | None = None) -> Index:
    """Assign every vector of (corpus_id, embedding, corpus_label) to a list and write the lists.

    One row per list comes to the driver.
    """
    rows = sample_of(corpus, sample or min(SAMPLE_MOST, SAMPLE_PER_LIST * lists))
    centroids = fit_centroids(rows, lists)
    kept = corpus.filter(has_direction())
    if not len(centroids):
        kept.withColumn("list", F.lit(0)).withColumn("angle", F.lit(0.0)).write.parquet(path)
        return Index(path, centroids, np.zeros(0, np.int64), np.zeros(0))
    nearest = _nearest_lists(centroids, 1)(F.col("embedding"))[0]
    assigned = kept.select("corpus_id", "embedding", "corpus_label", nearest.alias("of"))
    rows_of = assigned.select("corpus_id", "embedding", "corpus_label", "of.angle", "of.list")
    rows_of.hint("rebalance", "list").write.partitionBy("list").parquet(path)
    sizes, angles = np.zeros(len(centroids), np.int64), np.zeros(len(centroids))
    index = corpus.sparkSession.read.parquet(path)
    for r in index.groupBy("list").agg(F.count(F.lit(1)).alias("n"), F.max("angle").alias("widest")).collect():
        sizes[r["list"]], angles[r["list"]] = r["n"], r["widest"]
    return Index(path, centroids, sizes, angles)


def _asked(queries: DataFrame) -> DataFrame:
    return staged(queries.filter(has_direction()).select("query_id", "embedding"), "queries")


def _in_lists(index: Index, asked: DataFrame, n_queries: int, k: int) -> DataFrame:
    """The k nearest within the lists that ``asked`` (query_id, embedding, list) names."""
    spark = asked.sparkSession
    unit, search = block_search(k)
    blocks = {i: max(1, -(-int(n) // CORPUS_BLOCK)) for i, n in enumerate(index.sizes)}
    per_list = F.element_at(F.array(*[F.lit(blocks[i]) for i in range(len(blocks))]), F.col("list") + 1)
    q_blocks = max(1, -(-n_queries // QUERY_BLOCK))
    schema = pa.schema(
        [("query_id", pa.int64()), ("corpus_id", pa.int64()), ("sim", pa.float64()), ("corpus_label", pa.int32())]
    )

    def cell(q_part: pa.Table, c_part: pa.Table) -> pa.Table:
        found = []
        if len(q_part) and len(c_part):
            found = list(search(np.asarray(q_part.column("query_id")), unit(q_part.column("embedding")), c_part))
        return pa.Table.from_batches(found, schema)

    left = asked.select(
        "list", F.explode(F.sequence(F.lit(0), per_list - 1)).alias("cb"),
        F.pmod(F.xxhash64("query_id"), F.lit(q_blocks)).cast("int").alias("qb"), "query_id", "embedding",
    )
    right = spark.read.parquet(index.path).select(
        "list", F.pmod(F.xxhash64("corpus_id"), per_list).cast("int").alias("cb"),
        F.explode(F.sequence(F.lit(0), F.lit(q_blocks - 1))).alias("qb"), "corpus_id", "embedding", "corpus_label",
    )
    by = ["list", "cb", "qb"]
    return left.groupBy(*by).cogroup(right.groupBy(*by)).applyInArrow(cell, NEAREST_SCHEMA)


def _first(near: DataFrame, k: int) -> DataFrame:
    place = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("sim"), "corpus_id"))
    return near.withColumn("place", place).filter(F.col("place") <= k)


def search(index: Index, queries: DataFrame, k: int, probes: int) -> DataFrame:
    """(query_id, corpus_id, sim, corpus_label, place): the k nearest of each query's ``probes`` lists.

    ``queries`` has (query_id, embedding); a corpus row with the query's own id is left out. Ties of
    similarity go to the smaller id.
    """
    asked = _asked(queries)
    if not len(index.centroids):
        return _first(asked.limit(0).select(*_none()), k)
    lists = _nearest_lists(index.centroids, probes)(F.col("embedding"))
    probed = asked.select("query_id", "embedding", F.explode(lists).alias("of"))
    return _first(_in_lists(index, probed.select("query_id", "embedding", "of.list"), asked.count(), k), k)


def _none() -> list[Column]:
    kinds = (f.strip().split(" ") for f in NEAREST_SCHEMA.split(","))
    return [F.lit(None).cast(kind).alias(name) for name, kind in kinds]


def search_exact(index: Index, queries: DataFrame, k: int, probes: int) -> DataFrame:
    """As :func:`search`, over all lists that can hold one of the k nearest.

    The first lists give each query the similarity that its k-th neighbour has at least. A list whose
    widest angle leaves all its vectors farther than that is passed over; the others are searched as well.
    """
    asked = _asked(queries)
    if not len(index.centroids):
        return _first(asked.limit(0).select(*_none()), k)
    n = asked.count()
    lists = _nearest_lists(index.centroids, len(index.centroids))(F.col("embedding"))
    ranked = staged(asked.select("query_id", "embedding", lists.alias("lists")), "ranked-lists")
    each = ranked.select("query_id", "embedding", F.posexplode("lists").alias("rank", "of"))
    each = each.select("query_id", "embedding", "rank", "of.list", "of.angle")
    first = staged(_first(_in_lists(index, each.filter(F.col("rank") < probes), n, k), k), "first-lists")
    floor = first.filter(F.col("place") == k).select("query_id", F.col("sim").alias("floor"))
    widest = F.element_at(F.array(*[F.lit(float(a)) for a in index.angles]), F.col("list") + 1)
    best = F.cos(F.greatest(F.lit(0.0), F.col("angle") - widest))
    slack = 2 * 10.0**-SIMILARITY_DIGITS
    rest = each.filter(F.col("rank") >= probes).join(floor, "query_id", "left")
    rest = rest.filter(F.col("floor").isNull() | (best >= F.col("floor") - slack)).select("query_id", "embedding", "list")
    return _first(first.drop("place").unionByName(_in_lists(index, rest, n, k)), k)


def search_recall(index: Index, found: DataFrame, exact: DataFrame, probes: int) -> DataFrame:
    """One row: queries, the share of exact neighbours that a search found, and the most candidates a query can have.

    A neighbour counts as found if a row of its similarity was found, so that ties do not matter.
    """
    k_th = exact.groupBy("query_id").agg(F.min("sim").alias("floor"), F.count(F.lit(1)).alias("wanted"))
    hits = found.join(k_th, "query_id").filter(F.col("sim") >= F.col("floor")).groupBy("query_id")
    hits = hits.agg(F.count(F.lit(1)).alias("hits"))
    most = int(np.sort(index.sizes)[::-1][:probes].sum())
    return k_th.join(hits, "query_id", "left").agg(
        F.count(F.lit(1)).alias("n_queries"),
        (F.sum(F.coalesce("hits", F.lit(0))) / F.sum("wanted")).alias("recall"),
        F.lit(most).cast("long").alias("most_candidates"),
    )
