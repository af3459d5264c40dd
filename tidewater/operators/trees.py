"""UI trees flattened level by level with VARIANT functions, without Python workers.

The same rows as :func:`tidewater.operators.corpus.flatten_tree` for labels that are strings, whole numbers, booleans or missing. Each
level of all trees is one step: its nodes are read and written once, with their children, which are the next level, and a node's path of
child numbers gives the depth-first order in the end. The number of steps is the depth of the deepest tree; a tree's nodes
meet in one group, bounded by the tree.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.functions import computed_once
from tidewater.session import staged

# The characters that end a trimmed text.
_BLANK = "".join(map(chr, [*range(9, 14), *range(28, 33), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]))
_NODE = "struct<class: variant, text: variant, bounds: array<int>, children: array<variant>>"


def _label(text: str, value: str) -> Column:
    """The trimmed text of a field; values that count as false are empty."""
    kind = F.schema_of_variant(value)
    said = (
        F.when(F.col(text).isin("true", "false") & (kind == "BOOLEAN"), F.when(F.col(text) == "true", "True"))
        .when((F.col(text) == "0") & (kind == "BIGINT"), None)
        .otherwise(F.col(text))
    )
    return F.btrim(F.coalesce(said, F.lit("")), F.lit(_BLANK))


def _bounds(sides: str) -> Column:
    """Four whole numbers of 32 bits, else zeros."""
    fits = (F.size(sides) == 4) & (F.size(F.array_compact(sides)) == 4)
    return F.when(F.coalesce(fits, F.lit(False)), F.col(sides)).otherwise(F.array(*[F.lit(0)] * 4))


def _read(rows: DataFrame, keep: list[str], node: Column) -> DataFrame:
    """Columns ``keep`` and those of a node; all of them are NULL if the value is not an object."""
    read = computed_once(rows, keep, "node", F.try_variant_get(node, "$", _NODE))
    said = lambda c: F.try_variant_get(f"node.{c}", "$", "string").alias(f"said_{c}")
    fields = read.select(*keep, "node", F.col("node.class").alias("class"), F.col("node.text").alias("value"), said("class"), said("text"))
    there = lambda c: F.when(F.col("node").isNotNull(), c)
    return fields.select(
        *keep,
        there(_label("said_class", "class")).alias("cls"),
        there(_label("said_text", "value")).alias("text"),
        there(_bounds("node.bounds")).alias("bounds"),
        F.col("node.children").alias("children"),
    )


def flatten_tree_by_level(df: DataFrame, key: str, tree: str = "tree") -> DataFrame:
    """Rows (key, elements), one for each row of ``df``; text that is not JSON gives NULL."""
    keyed = df.select(F.monotonically_increasing_id().alias("row"), F.col(key).alias("key"), F.col(tree).alias("tree"))
    rows = computed_once(keyed, ["row", "key"], "doc", F.try_parse_json("tree"))
    rows = rows.select("row", "key", F.col("doc").isNotNull().alias("parsed"), F.array().cast("array<int>").alias("path"), "doc")
    root = F.coalesce(F.try_variant_get("doc", "$.activity.root", "variant"), F.col("doc"))
    rows = staged(_read(rows, ["row", "key", "parsed", "path"], root), "trees")
    level, found = rows, []
    while True:
        labelled = level.select("row", "path", "cls", "text", "bounds")
        found.append(labelled.filter((F.col("cls") != "") | (F.col("text") != "")))
        parents = level.filter(F.col("children").isNotNull())
        if parents.isEmpty():
            break
        below = parents.select("row", "path", F.posexplode("children").alias("place", "node"))
        below = below.select("row", F.concat("path", F.array("place")).alias("path"), "node")
        level = staged(_read(below, ["row", "path"], F.col("node")), "tree-level")
    every = found[0]
    for nodes in found[1:]:
        every = every.unionByName(nodes)
    in_order = F.array_sort(F.collect_list(F.struct("path", "cls", "text", "bounds")))
    elements = every.groupBy(F.col("row").alias("of")).agg(in_order.alias("found"))
    plain = F.transform("found", lambda e: F.struct(e["cls"].alias("cls"), e["text"].alias("text"), e["bounds"].alias("bounds")))
    none = F.array().cast("array<struct<cls:string,text:string,bounds:array<int>>>")
    joined = rows.select("row", "key", "parsed").join(elements, F.col("row") == F.col("of"), "left")
    return joined.select(F.col("key").alias(key), F.when(F.col("parsed"), F.coalesce(plain, none)).alias("elements"))
