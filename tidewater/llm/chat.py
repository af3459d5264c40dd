r"""Chat formatting in budgeted windows.

The turns of a conversation, by ``turn`` (ties by role, then text; nulls first), get token
counts, and prefix sums of the counts place each turn in a window: a window holds the
turns that begin within one share of the conversation's tokens. In front of its own turns it
repeats the leading system turn and as many turns of the history as fit into their share,
always whole turns. Only the first appearance of a text is a target: repeated turns are
masked, so over all windows each assistant text is under the loss mask once.

Template: ``<s>[role]`` text ``</s>``. In texts and roles a backslash is doubled, and one is
put before ``<s>``, ``</s>`` and ``]`` (the latter in roles only), so that a turn's end and start
cannot occur inside a text, and ``parse`` gives back what was said.

A turn longer than a window's share is a window of its own kind: it is never cut. Null
texts and roles are empty; a null conv_id is a conversation; repeated rows are turns like
others; an empty table gives no windows. Prefix sums are taken within ranges of the sorted
turns and then shifted by the sums of the ranges before, so a conversation with a third of
all rows is spread over many tasks.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewater.llm.staging import staged

SHARE = 512  # tokens of a window's own turns
HISTORY = 256  # tokens of the system turn and of repeated history
MARKS = 8  # tokens that a turn's marks cost

WINDOW = "struct<text:string,n_repeated:int,loss:array<struct<start:int,end:int>>>"
TURNS = "array<struct<role:string,text:string,loss:string>>"

_CONTROL = re.compile(r"\\|</?s>")
_ROLE_CONTROL = re.compile(r"\\|</?s>|\]")
_TURN = re.compile(r"<s>\[((?:\\.|[^\]\\])*)\]((?:\\.|(?!</s>)[^\\])*)</s>", re.DOTALL)
_ESCAPED = re.compile(r"\\(.)", re.DOTALL)


def escape(text: str, control: re.Pattern = _CONTROL) -> str:
    return control.sub(lambda m: "\\" + m[0], text) if control.search(text) else text


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text) if "\\" in text else text


def render(turns: list[tuple[str, str, bool]]) -> tuple[str, int, list[tuple[int, int]]]:
    """Text of a window, how many turns are repeated, and the spans of its targets.

    ``turns``: role, text and whether the turn is the window's own.
    """
    parts, at, loss = [], 0, []
    for role, text, own in turns:
        head, body = f"<s>[{escape(role, _ROLE_CONTROL)}]", escape(text)
        if own and role == "assistant":
            loss.append((at + len(head), at + len(head) + len(body)))
        parts += [head, body, "</s>"]
        at += len(head) + len(body) + 4
    return "".join(parts), sum(not own for *_, own in turns), loss


def parse(text: str) -> list[tuple[str, str, int, int]]:
    """Role, text, and the span of the escaped text, of each turn in a window."""
    return [(unescape(m[1]), unescape(m[2]), m.start(2), m.end(2)) for m in _TURN.finditer(text)]


def windows(
    turns: DataFrame, n_tokens: Column, share: int = SHARE, history: int = HISTORY
) -> DataFrame:
    """Windows of all conversations: conv_id, window, text, n_repeated, loss.

    ``n_tokens`` counts the tokens of a row of ``turns`` (conv_id, turn, role, text).
    """
    by = ["turn", "role", "text", "tie"]
    rows = turns.select(
        "conv_id",
        "turn",
        F.coalesce(F.col("role"), F.lit("")).alias("role"),
        F.coalesce(F.col("text"), F.lit("")).alias("text"),
        (n_tokens.cast("long") + MARKS).alias("n"),
        F.monotonically_increasing_id().alias("tie"),
    )
    ranged = rows.repartitionByRange("conv_id", *by).withColumn("part", F.spark_partition_id())
    ranged = staged(ranged, "chat-turns")  # the ranges have to stay as they are
    before = Window.partitionBy("part", "conv_id").orderBy(*by).rowsBetween(Window.unboundedPreceding, -1)
    local = ranged.select(
        "*",
        F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"),
        F.count(F.lit(1)).over(before).alias("place"),
    )
    earlier = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sums = ranged.groupBy("conv_id", "part").agg(F.sum("n").alias("sum"), F.count(F.lit(1)).alias("count"))
    shifts = sums.select(
        F.col("conv_id").alias("shift_conv"),
        F.col("part").alias("shift_part"),
        F.coalesce(F.sum("sum").over(earlier), F.lit(0)).alias("start_shift"),
        F.coalesce(F.sum("count").over(earlier), F.lit(0)).alias("place_shift"),
    )
    placed = local.join(
        shifts, (F.col("part") == F.col("shift_part")) & F.col("conv_id").eqNullSafe(F.col("shift_conv"))
    ).select(
        "conv_id",
        "role",
        "text",
        "n",
        (F.col("start") + F.col("start_shift")).alias("start"),
        (F.col("place") + F.col("place_shift")).alias("place"),
    )
    placed = staged(placed, "chat-places")
    system = placed.where((F.col("place") == 0) & (F.col("role") == "system")).select(
        F.col("conv_id").alias("system_conv"), F.col("text").alias("system"), F.col("n").alias("system_n")
    )
    left = F.greatest(F.lit(0), F.lit(history) - F.coalesce(F.col("system_n"), F.lit(0)))
    window = F.floor(F.col("start") / share)
    known = placed.join(system, F.col("conv_id").eqNullSafe(F.col("system_conv")), "left").select(
        "conv_id", "role", "text", "place", "system", window.alias("own"),
        # The next window repeats a turn that begins within the history's share before it.
        ((F.col("start") >= (window + 1) * share - left) & ~((F.col("place") == 0) & F.col("system").isNotNull())).alias("again"),
    )
    uses = F.when(F.col("again"), F.array("own", F.col("own") + 1)).otherwise(F.array("own"))
    spread = known.select("*", F.explode(uses).alias("window"))
    turn = F.struct("place", "role", "text", (F.col("own") == F.col("window")).alias("fresh"))
    # A window holds a bounded number of tokens and each turn costs some, so these groups are bounded.
    grouped = (
        spread.groupBy("conv_id", "window")
        .agg(
            F.sort_array(F.collect_list(turn)).alias("turns"),
            F.max(F.col("own") == F.col("window")).alias("any_fresh"),
            F.min("place").alias("first_place"),
            F.max("system").alias("system"),
        )
        .where("any_fresh")
    )
    head = F.when(
        F.col("system").isNotNull() & (F.col("first_place") > 0),
        F.array(F.struct(F.lit(0).cast("long").alias("place"), F.lit("system").alias("role"), F.col("system").alias("text"), F.lit(False).alias("fresh"))),
    ).otherwise(F.expr("filter(turns, x -> false)"))
    formatted = grouped.select("conv_id", "window", _render(F.concat(head, "turns")).alias("made"))
    return formatted.select("conv_id", "window", "made.*")


def _render(turns: Column) -> Column:
    def made(rows: pa.Array) -> pa.Array:
        out = []
        for row in rows.to_pylist():
            text, repeated, loss = render([(t["role"], t["text"], t["fresh"]) for t in row])
            out.append({"text": text, "n_repeated": repeated, "loss": [{"start": a, "end": b} for a, b in loss]})
        span = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
        return pa.array(out, pa.struct([("text", pa.string()), ("n_repeated", pa.int32()), ("loss", span)]))

    made.__annotations__ = {"rows": pa.Array, "return": pa.Array}
    return F.arrow_udf(made, WINDOW)(turns)


def own_turns(text: Column, n_repeated: Column, loss: Column) -> Column:
    """A window's own turns, read back from its text: role, text, and what of it is under the loss mask."""

    def read(texts: pa.Array, skip: pa.Array, spans: pa.Array) -> pa.Array:
        out = []
        for t, n, row in zip(texts.to_pylist(), skip.to_pylist(), spans.to_pylist()):
            marked = {(s["start"], s["end"]): unescape(t[s["start"] : s["end"]]) for s in row}
            out.append(
                [{"role": r, "text": x, "loss": marked.get((a, b))} for r, x, a, b in parse(t)[n:]]
            )
        return pa.array(out, pa.list_(pa.struct([("role", pa.string()), ("text", pa.string()), ("loss", pa.string())])))

    read.__annotations__ = {"texts": pa.Array, "skip": pa.Array, "spans": pa.Array, "return": pa.Array}
    return F.arrow_udf(read, TURNS)(text, n_repeated, loss)


def digests(formatted: DataFrame) -> DataFrame:
    """Per conversation, from its windows alone: turns and targets as counts and SHA-256.

    A digest needs a conversation's bytes in order, so its windows meet in one task; they
    pass through it one by one, and only running hashes are held.
    """
    import hashlib

    ordered = (
        formatted.select(
            "conv_id", "window", F.length("text").alias("chars"), own_turns(F.col("text"), F.col("n_repeated"), F.col("loss")).alias("turns")
        )
        .repartition("conv_id")
        .sortWithinPartitions("conv_id", "window")
    )
    schema = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def row():
            return [conv, n_turns, turns.hexdigest(), loss_chars, loss.hexdigest(), chars]

        def table(rows):
            names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

        started, conv = False, None
        for batch in batches:
            done = []
            for r in batch.to_pylist():
                if not started or r["conv_id"] != conv:
                    if started:
                        done.append(row())
                    started, conv = True, r["conv_id"]
                    n_turns, loss_chars, chars, turns, loss = 0, 0, 0, hashlib.sha256(), hashlib.sha256()
                chars += r["chars"]
                for t in r["turns"]:
                    n_turns += 1
                    turns.update(f"{t['role']}\n{t['text']}\n".encode())
                    if t["loss"] is not None:
                        loss_chars += len(t["loss"])
                        loss.update(t["loss"].encode())
            if done:
                yield table(done)
        if started:
            yield table([row()])

    return ordered.mapInArrow(fold, schema)
