"""Links among nodes that share buckets, without all pairs of a bucket.

Every node is first compared with the smallest leader (smallest node of a bucket) it meets; most
nodes of a group of copies have the same leader after that. Then each bucket's leader, and a member
picked by hash, are compared with the bucket's nodes that have another one: with as many picks as it has
buckets, a node of a loose group finds one of its neighbours. What is still in another
component, the strays, are not compared pairwise either: two sets of similarity t or more share an element in the rarest part that
holds more than 1 - t of each, so strays meet others of their buckets through these rare elements
alone, and only where two bounds leave a similarity of t possible: what stands before the shared element in the order of rarity is in
one of the sets alone, and every bit in which the parities of two sets differ is an element that one of them
lacks. All links within a bucket end up within one component; none is lost to a cap or a bound.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewater.llm.arrow import list_of
from tidewater.llm.components import components
from tidewater.llm.staging import staged
from tidewater.llm.words import mix

# 64-bit words of a set's parities.
PARITY_WORDS = 8
# Bits of the map by which rows are left out before a join: 2 MB.
FILTER_BITS = 1 << 24


def similarity(x: np.ndarray, xw: np.ndarray, y: np.ndarray, yw: np.ndarray) -> float:
    """Probability Jaccard of two weighted sets (sorted elements); plain Jaccard where all weights are 1."""
    shared, i, j = np.intersect1d(x, y, assume_unique=True, return_indices=True)
    if not len(shared):
        return 0.0
    ratio, n = np.unique(xw[i] / yw[j], return_counts=True)
    only_x, only_y = np.ones(len(x), bool), np.ones(len(y), bool)
    only_x[i], only_y[j] = False, False
    rest_x, rest_y = xw[only_x].sum(), yw[only_y].sum()
    total = 0.0
    for c in ratio:
        mine = xw[i] / yw[j] == c
        # max(x_e / x_d, y_e / y_d) over all e, times x_d, is the same for all d of a ratio.
        whole = np.maximum(xw[i], c * yw[j]).sum() + rest_x + c * rest_y
        total += xw[i][mine].sum() / whole
    return float(total)


def _plain(x: np.ndarray, x_ends: np.ndarray, y: np.ndarray, y_ends: np.ndarray) -> np.ndarray:
    """Jaccard of pairs of sets, those of each side one after another."""
    n = len(x_ends) - 1
    items = np.concatenate([x[x_ends[0] : x_ends[-1]], y[y_ends[0] : y_ends[-1]]])
    row = np.concatenate([np.repeat(np.arange(n), np.diff(ends)) for ends in (x_ends, y_ends)])
    order = np.lexsort((items, row))
    items, row = items[order], row[order]
    shared = np.bincount(row[1:][(items[1:] == items[:-1]) & (row[1:] == row[:-1])], minlength=n)
    return shared / np.maximum(np.diff(x_ends) + np.diff(y_ends) - shared, 1)


def similar(a: Column, a_weights: Column, b: Column, b_weights: Column, threshold: float) -> Column:
    """Whether two weighted sets (arrays of sorted elements and of weights) are as similar as that."""

    def compare(batches: Iterator[tuple[pa.Array, pa.Array, pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for columns in batches:
            parts = []
            for column in columns:
                ends = np.asarray(column.offsets)
                parts.append((np.asarray(column.values), ends))
            if all((v[e[0] : e[-1]] == 1).all() for v, e in parts[1::2]):
                yield pa.array(_plain(*parts[0], *parts[2]) >= threshold - 1e-9)
                continue
            out = []
            for k in range(len(columns[0])):
                x, xw, y, yw = (v[e[k] : e[k + 1]] for v, e in parts)
                out.append(similarity(x, xw.astype(float), y, yw.astype(float)) >= threshold - 1e-9)
            yield pa.array(out, pa.bool_())

    compare.__annotations__ = {
        "batches": Iterator[tuple[pa.Array, pa.Array, pa.Array, pa.Array]],
        "return": Iterator[pa.Array],
    }
    return F.arrow_udf(compare, "boolean")(a, a_weights, b, b_weights)


def parity_words(ends: np.ndarray, values: np.ndarray) -> pa.Array:
    """The parities (see :func:`parities`) of sets that lie one after another; ``ends`` begins with 0."""
    size, n = 64 * PARITY_WORDS, len(ends) - 1
    row = np.repeat(np.arange(n), np.diff(ends))
    cells = row * size + (mix(values) % np.uint64(size)).astype(np.int64)
    odd = (np.bincount(cells, minlength=n * size) & 1).astype(np.uint8).reshape(-1, size)
    flat = np.packbits(odd, axis=1, bitorder="little").view(np.int64).ravel()
    return list_of(np.arange(n + 1) * PARITY_WORDS, pa.array(flat))


def parities(items: Column) -> Column:
    """PARITY_WORDS longs whose bits say whether an even or odd number of a set's elements fall on them."""

    def words(column: pa.Array) -> pa.Array:
        ends = np.asarray(column.offsets).astype(np.int64)
        return parity_words(ends - ends[0], np.asarray(column.values)[ends[0] : ends[-1]].view(np.uint64))

    words.__annotations__ = {"column": pa.Array, "return": pa.Array}
    return F.arrow_udf(words, "array<long>")(items)


def _possible(x: Column, y: Column, threshold: float) -> Column:
    """Whether sets may be as similar of which shares x and y are not in the other one: (1 - x)(1 - y) / (1 - xy) at most."""
    return (1 - x) * (1 - y) >= threshold * (1 - x * y) - 1e-9


def _parities_allow(a: Column, a_all: Column, b: Column, b_all: Column, threshold: float) -> Column:
    """The same for sets (weights of 1 or more) whose parities differ in so many bits, dealt between both as it suits them best."""
    apart = F.bit_count(a[0].bitwiseXOR(b[0]))
    for i in range(1, PARITY_WORDS):
        apart = apart + F.bit_count(a[i].bitwiseXOR(b[i]))
    return apart * (1 + threshold) <= 2 * F.greatest(a_all, b_all) * (1 - threshold) + 1e-6


def _verified(pairs: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """The pairs (a, b) whose sets are similar enough. Each side's sets are joined on, and not kept."""
    side = lambda s: sets.select(F.col("node").alias(f"{s}_node"), F.col("items").alias(f"{s}_items"), F.col("weights").alias(f"{s}_weights"))
    joined = pairs.join(side("b"), F.col("b") == F.col("b_node")).join(side("a"), F.col("a") == F.col("a_node"))
    good = similar(F.col("a_items"), F.col("a_weights"), F.col("b_items"), F.col("b_weights"), threshold)
    return joined.select("a", "b", good.alias("good")).where("good").select("a", "b")


def likely(rows: DataFrame, key: str, wanted: DataFrame) -> DataFrame:
    """Those rows, among them all whose key (long) is among the wanted ones (one column) and few others.

    A bitmap of fixed size says which hashes are wanted, so that most rows are left out where they lie before a join
    that would shuffle them.
    """
    place = lambda c: F.pmod(F.xxhash64(c), F.lit(FILTER_BITS)) + 1
    asked = place(F.col(wanted.columns[0]).cast("long"))
    bits = wanted.groupBy(F.bitmap_bucket_number(asked).alias("_part")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(asked)).alias("_bits"))
    own = place(F.col(key))
    at = F.bitmap_bit_position(own)
    byte = F.conv(F.hex(F.substring("_bits", (at / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    met = rows.join(F.broadcast(bits), F.bitmap_bucket_number(own) == F.col("_part"))
    return met.where(byte.bitwiseAND(F.call_function("shiftleft", F.lit(1), (at % 8).cast("int"))) != 0).select(*rows.columns)


def link(
    members: DataFrame, sets_of: Callable[[DataFrame], DataFrame], threshold: float
) -> tuple[DataFrame, DataFrame]:
    """Verified links and components (node, label) of nodes in shared buckets.

    ``members``: (bucket, node). ``sets_of`` takes a DataFrame of nodes and gives (node, items, weights), and their
    parity if it has it at hand: a UDF after a Python step takes a second worker for each task.
    """
    ends = members.groupBy("bucket").agg(F.min("node").alias("leader"), F.max("node").alias("last"))
    leaders = staged(ends.where("leader < last").select(F.col("bucket").alias("of"), "leader"), "bucket-leaders")
    shared = members.join(leaders, F.col("bucket") == F.col("of")).select("bucket", "node", "leader").distinct()
    shared = staged(shared, "bucket-nodes")
    # Besides the smallest node, every bucket has a member picked by hash: other buckets, other members.
    picked = F.min(F.struct(F.xxhash64("bucket", "node").alias("h"), "node"))["node"]
    picks = shared.groupBy(F.col("bucket").alias("of")).agg(picked.alias("pick"))
    shared = shared.join(picks, F.col("bucket") == F.col("of")).select("bucket", "node", "leader", "pick")
    shared = staged(shared, "bucket-members")
    sets = sets_of(shared.select("node").distinct())
    if "parity" not in sets.columns:
        sets = sets.select("*", parities(F.col("items")).alias("parity"))
    sets = staged(sets, "bucket-sets")

    first = shared.where("node <> leader").groupBy("node").agg(F.min("leader").alias("a"))
    first = staged(first.select("a", F.col("node").alias("b")), "pairs")
    links = staged(_verified(first, sets, threshold), "links")
    # Each node has one link so far, to the leader it was compared with: that leader is its label for now.
    labels = links.select(F.col("b").alias("node"), F.col("a").alias("label"))

    apart = [_apart(shared, other, labels).select(F.least(other, "node").alias("a"), F.greatest(other, "node").alias("b")) for other in ("leader", "pick")]
    second = apart[0].unionByName(apart[1]).distinct()
    second = staged(second.join(first, ["a", "b"], "left_anti"), "pairs")
    links = staged(links.unionByName(_verified(second, sets, threshold)), "links")
    labels = components(links)

    strays = staged(_apart(shared, "leader", labels), "strays")
    rest = _by_rare_items(strays, shared, labels, sets, threshold)
    found = staged(_verified(rest, sets, threshold), "links")
    if found.isEmpty():
        return links, labels
    links = links.unionByName(found)
    return links, components(links)


def labelled(rows: DataFrame, column: str, labels: DataFrame, to: str) -> DataFrame:
    """Rows with the label of a node column; a node without a label is its own."""
    named = labels.select(F.col("node").alias("_of"), F.col("label").alias("_label"))
    joined = rows.join(named, F.col(column) == F.col("_of"), "left")
    return joined.select(*[F.col(c) for c in rows.columns], F.coalesce("_label", column).alias(to))


def _apart(shared: DataFrame, other: str, labels: DataFrame) -> DataFrame:
    """Members of a bucket in another component than one of its columns' nodes."""
    rows = shared.where(F.col("node") != F.col(other)).select("bucket", "node", other)
    rows = labelled(labelled(rows, "node", labels, "label"), other, labels, "other_label")
    return rows.where("label <> other_label").select("bucket", "node", other)


def _by_rare_items(
    strays: DataFrame, shared: DataFrame, labels: DataFrame, sets: DataFrame, threshold: float
) -> DataFrame:
    """Pairs (a, b) of a stray and a node of another component that share a rare item."""
    open_buckets = strays.select("bucket").distinct()
    stray = strays.select(F.col("node").alias("stray")).distinct()
    nodes = shared.join(open_buckets, "bucket", "left_semi").select("node").distinct()
    known = labelled(nodes, "node", labels, "label").join(stray, F.col("node") == F.col("stray"), "left")
    items = (
        known.join(sets, "node")
        .select("node", "label", F.col("stray").isNotNull().alias("is_stray"), F.explode(F.arrays_zip("items", "weights")).alias("x"))
        .select("node", "label", "is_stray", F.col("x.items").alias("item"), F.col("x.weights").alias("weight"))
    )
    items = staged(items, "stray-items")
    # Pairs are wanted across components, so an item that only one component holds cannot be shared.
    often = items.groupBy(F.col("item").alias("often")).agg(
        F.count(F.lit(1)).alias("n"), (F.min("label") != F.max("label")).alias("across")
    )
    whole = Window.partitionBy("node")
    before = whole.orderBy("across", "n", "item").rowsBetween(Window.unboundedPreceding, -1)
    counted = items.join(often, F.col("item") == F.col("often")).select(
        "node", "label", "is_stray", "item", "across",
        F.coalesce(F.sum("weight").over(before), F.lit(0)).alias("before"),
        F.sum("weight").over(whole).alias("all"),
    )
    rare = counted.where((F.col("before") <= (1 - threshold) * F.col("all") + 1e-9) & F.col("across"))
    rare = rare.select("node", "label", "is_stray", "item", (F.col("before") / F.col("all")).alias("alone"), "all")
    signs = known.select("node").join(sets.select(F.col("node").alias("of"), "parity"), F.col("node") == F.col("of"))
    rare = staged(rare.join(staged(signs.select("of", "parity"), "parities"), F.col("node") == F.col("of")).drop("of"), "rare-items")
    side = lambda s: [F.col(c).alias(f"{s}_{c}") for c in ("label", "item", "alone", "all", "parity")]
    left = rare.where("is_stray").select(F.col("node").alias("b"), *side("b"))
    right = rare.select(F.col("node").alias("a"), *side("a"))
    met = left.join(
        right,
        (F.col("b_item") == F.col("a_item"))
        & (F.col("a_label") != F.col("b_label"))
        # At the rarest element that both hold, all rarer ones are in one of them alone.
        & _possible(F.col("a_alone"), F.col("b_alone"), threshold)
        & _parities_allow(F.col("a_parity"), F.col("a_all"), F.col("b_parity"), F.col("b_all"), threshold),
    )
    return met.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
