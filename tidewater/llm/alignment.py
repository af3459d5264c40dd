"""Alignment of the tokens that two tokenizers give a text.

A is a byte-level BPE vocabulary, B a sentencepiece model. Both cut the same bytes, a space and then the
text; special tokens' strings within a text are plain text. Where tokens of A and of B both end
is a cut; cuts part the tokens into groups. A link is an A token and a B token whose byte ranges overlap.

The merge of the two sequences runs in lockstep: one state vector holds, for every text of a batch,
the place of its current A token and of its current B token. A step emits the link of each text's
current tokens, notes a cut where both end, advances the token that ends first (or
both), and drops the texts that are through. A long text takes part as several lanes of LANE
tokens of A, each begun at the B token that overlaps its first byte, so that the number of steps does
not grow with the longest text.

An id pair's count is the number of links of the whole corpus that hold it. Links of a block of
texts are kept as places in the block's list of distinct pairs; lists of all blocks are summed by pair,
and each block gets back the sums of its own pairs, so a row is shuffled for a pair and block, not for a
link, however often a pair occurs. Blocks are bounded by BLOCK_BYTES of text (one text at least).

Texts that are null or empty, or whose tokens' bytes, joined, differ from the space and the text for A or B
(a literal U+2581, which B takes for a space), have no tokens: counts of 0 and no groups. Repeated rows, also of
equal keys, are rows of their own; ties of counts are all best. All columns but the text are
carried in one struct, so their names may be any and their values null. An empty table gives no rows.
"""

from __future__ import annotations

import functools
import itertools
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import sentencepiece
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, LongType, StringType, StructField, StructType

from tidewater.llm.arrow import list_of, ranges
from tidewater.llm.bpe import ByteBPE
from tidewater.llm.staging import staged

# A tokens of a lane: bounds the steps of a batch to about the A and B tokens of a lane.
LANE = 256
# Bytes of the texts that are aligned at once and share one list of pairs.
BLOCK_BYTES = 1 << 20


@dataclass
class Tokens:
    """Token ids of several texts, one text after another, and how many belong to each."""

    ids: np.ndarray
    counts: np.ndarray

    def only(self, keep: np.ndarray) -> Tokens:
        """Without the tokens of the texts that are not to be kept."""
        return Tokens(self.ids[np.repeat(keep, self.counts)], np.where(keep, self.counts, 0))


class TokenBytes:
    """The bytes of each token of a vocabulary."""

    def __init__(self, tokens: list[bytes]):
        self.length = np.array([len(t) for t in tokens], np.int64)
        self.at = np.cumsum(self.length) - self.length
        self.data = np.frombuffer(b"".join(tokens), np.uint8)

    def join(self, tokens: Tokens) -> list[bytes]:
        lengths = self.length[tokens.ids]
        data = self.data[ranges(self.at[tokens.ids], lengths)].tobytes()
        ends = np.r_[0, np.cumsum(lengths)][np.cumsum(tokens.counts)].tolist()
        return [data[x:y] for x, y in zip([0, *ends], ends)]


class Pair:
    """Two tokenizers, by the files of their vocabularies."""

    def __init__(self, a_path: str, b_path: str):
        self.a = ByteBPE(a_path)
        self.a.split = None  # strings of special tokens are plain text
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        at, length, data = self.a.token_at, self.a.token_len, self.a.token_bytes.tobytes()
        self.a_bytes = TokenBytes([data[x : x + n] for x, n in zip(at.tolist(), length.tolist())])
        self.b_bytes = TokenBytes([self._b_token(i) for i in range(self.b.get_piece_size())])
        digits = [str(i).encode() + b"," for i in range(max(len(self.a_bytes.length), len(self.b_bytes.length)))]
        self.decimal = TokenBytes(digits)

    def _b_token(self, i: int) -> bytes:
        piece = self.b.id_to_piece(i)
        return bytes([int(piece[1:-1], 16)]) if self.b.is_byte(i) else piece.replace("▁", " ").encode()

    def encode(self, texts: list[str | None]) -> tuple[Tokens, Tokens]:
        """Tokens of A and of B; none for a text whose bytes one of them does not give back."""
        texts = [t or "" for t in texts]
        a = Tokens(*self.a.encode([f" {t}" if t else "" for t in texts]))
        b_ids = self.b.encode(texts, num_threads=1)
        b_counts = np.fromiter(map(len, b_ids), np.int64, len(texts))
        b = Tokens(np.fromiter(itertools.chain.from_iterable(b_ids), np.int32, int(b_counts.sum())), b_counts)
        same = [
            bool(t) and x == y == b" " + t.encode() for t, x, y in zip(texts, self.a_bytes.join(a), self.b_bytes.join(b))
        ]
        return a.only(np.array(same, bool)), b.only(np.array(same, bool))


@functools.cache
def pair_of(a_path: str, b_path: str) -> Pair:
    """Both tokenizers, loaded once by each worker."""
    return Pair(a_path, b_path)


def lockstep(
    a_end: np.ndarray, b_end: np.ndarray, a: np.ndarray, b: np.ndarray, stop: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Links (A place, B place) and cuts (A place, B place) of lanes, by place of the A token.

    ``a_end`` and ``b_end`` are the byte ends of all tokens. Lane i begins with the tokens ``a[i]`` and ``b[i]`` and ends
    when A reaches ``stop[i]``.
    """
    go = a < stop
    a, b, stop = a[go], b[go], stop[go]
    links_a, links_b, cuts_a, cuts_b = [], [], [], []
    while len(a):
        a_ends, b_ends = a_end[a], b_end[b]
        links_a.append(a)
        links_b.append(b)
        both = a_ends == b_ends
        cuts_a.append(a[both])
        cuts_b.append(b[both])
        a, b = a + (a_ends <= b_ends), b + (b_ends <= a_ends)
        go = a < stop
        if not go.all():
            a, b, stop = a[go], b[go], stop[go]
    none = [np.zeros(0, np.int64)]
    links_a, links_b = np.concatenate(links_a or none), np.concatenate(links_b or none)
    cuts_a, cuts_b = np.concatenate(cuts_a or none), np.concatenate(cuts_b or none)
    order, cut_order = np.argsort(links_a, kind="stable"), np.argsort(cuts_a)
    return links_a[order], links_b[order], cuts_a[cut_order], cuts_b[cut_order]


@dataclass
class Alignment:
    """Links and cuts of the tokens of several texts; places count over all texts."""

    a: Tokens
    b: Tokens
    links_a: np.ndarray
    links_b: np.ndarray
    cuts_a: np.ndarray  # the last A token of each group
    cuts_b: np.ndarray  # and its last B token

    @functools.cached_property
    def n_groups(self) -> np.ndarray:
        return self._per_text(self.cuts_a)

    @functools.cached_property
    def n_links(self) -> np.ndarray:
        return self._per_text(self.links_a)

    def _per_text(self, places: np.ndarray) -> np.ndarray:
        ends = np.searchsorted(places, np.cumsum(self.a.counts))
        return np.diff(np.r_[0, ends])


def aligned(pair: Pair, a: Tokens, b: Tokens, lane: int = LANE) -> Alignment:
    """The lockstep merge of all texts' tokens."""
    a_end, b_end = np.cumsum(pair.a_bytes.length[a.ids]), np.cumsum(pair.b_bytes.length[b.ids])
    lanes = -(-a.counts // lane)
    text_end = np.repeat(np.cumsum(a.counts), lanes)
    first = ranges(np.zeros(len(lanes), np.int64), lanes) * lane + np.repeat(np.cumsum(a.counts) - a.counts, lanes)
    begins = np.r_[0, a_end][first]
    # Texts give A and B the same bytes, so ends of all texts in a row can be compared.
    found = lockstep(a_end, b_end, first, np.searchsorted(b_end, begins, side="right"), np.minimum(first + lane, text_end))
    return Alignment(a, b, *found)


def groups_text(pair: Pair, x: Alignment) -> list[str]:
    """The groups of each text as ``a1,a2|b1;a3|b2,b3``, in decimal ids; '' for a text without tokens."""
    n_a, n_b, n_cuts = len(x.a.ids), len(x.b.ids), len(x.cuts_a)
    a_sizes, b_sizes = np.diff(np.r_[-1, x.cuts_a]), np.diff(np.r_[-1, x.cuts_b])
    # An A token stands behind the B tokens of earlier groups, a B token behind the A tokens up to its own group.
    at_a = np.arange(n_a) + np.repeat(x.cuts_b + 1 - b_sizes, a_sizes)
    at_b = np.arange(n_b) + np.repeat(x.cuts_a + 1, b_sizes)
    ids, mark = np.empty(n_a + n_b, np.int64), np.full(n_a + n_b, ord(","), np.uint8)
    ids[at_a], ids[at_b] = x.a.ids, x.b.ids
    mark[at_a[x.cuts_a]], mark[at_b[x.cuts_b]] = ord("|"), ord(";")
    lengths = pair.decimal.length[ids]
    data = pair.decimal.data[ranges(pair.decimal.at[ids], lengths)]
    ends = np.cumsum(lengths)
    data[ends - 1] = mark
    text = data.tobytes().decode("ascii")
    last = np.r_[0, ends][np.cumsum(x.a.counts + x.b.counts)].tolist()
    return [text[s : e - 1] if e > s else "" for s, e in zip([0, *last], last)] if n_cuts else [""] * len(x.a.counts)


def pack(*columns: np.ndarray) -> bytes:
    """Columns of numbers below 2**32, small ones mostly, as compressed planes of bytes."""
    planes = np.stack(columns).astype("<u4").view(np.uint8).reshape(len(columns), -1, 4)
    return zstandard.ZstdCompressor(level=1).compress(planes.transpose(0, 2, 1).tobytes())


def unpack(data: bytes, n_columns: int) -> np.ndarray:
    """The columns as rows of one array."""
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8).reshape(n_columns, 4, -1)
    return np.ascontiguousarray(planes.transpose(0, 2, 1)).view("<u4")[:, :, 0].astype(np.int64)


def _distinct_links(x: Alignment) -> tuple[list[np.ndarray], list[bytes]]:
    """The distinct id pairs (a, b, links that hold it), and each text's links: steps between places in that list, and times."""
    keys = x.a.ids[x.links_a].astype(np.int64) << 32 | x.b.ids[x.links_b]
    pairs, places, n = np.unique(keys, return_inverse=True, return_counts=True)
    texts = np.repeat(np.arange(len(x.n_links)), x.n_links)
    held, times = np.unique(texts * max(1, len(pairs)) + places, return_counts=True)
    of_text, place = np.divmod(held, max(1, len(pairs)))
    ends = np.searchsorted(of_text, np.arange(len(x.n_links)), side="right").tolist()
    links = []
    for s, e in zip([0, *ends], ends):
        links.append(pack(np.diff(place[s:e], prepend=0), times[s:e]))
    return [(pairs >> 32).astype(np.int32), (pairs & 0xFFFFFFFF).astype(np.int32), n], links


def _blocks(sizes: list[int]) -> Iterator[tuple[int, int]]:
    """Ranges of rows of BLOCK_BYTES at most, one row at least."""
    first, total = 0, 0
    for i, size in enumerate(sizes):
        if i > first and total + size > BLOCK_BYTES:
            yield first, i
            first, total = i, 0
        total += size
    if sizes:
        yield first, len(sizes)


_COUNTS = ("n_a", "n_b", "n_groups", "n_links")
_PAIRS = ArrayType(StructType().add("a", "integer").add("b", "integer").add("n", "long"))
_PAIR_TYPE = pa.struct([("a", pa.int32()), ("b", pa.int32()), ("n", pa.int64())])


def align(docs: DataFrame, a_path: str, b_path: str, text: str = "text") -> DataFrame:
    """Every row's alignment.

    ``doc`` holds the row's other columns; ``n_a``, ``n_b``, ``n_groups`` and ``n_links`` count its tokens, groups and
    links, ``groups`` has the ids of all groups (see :func:`groups_text`). ``block``, ``links`` and ``pairs`` are for
    :func:`scored`: the row's distinct links as places in its block's list of pairs, which the block's first row holds.
    """
    carried = [c for c in docs.columns if c != text]
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in carried]).alias("doc"), F.col(f"`{text}`").alias("text"))
    schema = StructType(
        [rows.schema["doc"]]
        + [StructField(c, LongType()) for c in _COUNTS]
        + [StructField("groups", StringType()), StructField("block", LongType()), StructField("links", BinaryType())]
    )
    schema = schema.add("pairs", _PAIRS)

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = pair_of(a_path, b_path)
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            texts = batch.column("text").to_pylist()
            for s, e in _blocks([len(t or "") for t in texts]):
                x = aligned(pair, *pair.encode(texts[s:e]))
                (a, b, n), links = _distinct_links(x)
                entries = pa.StructArray.from_arrays([pa.array(a), pa.array(b), pa.array(n)], fields=list(_PAIR_TYPE))
                first = np.arange(e - s) == 0
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc").slice(s, e - s),
                        *[pa.array(c, pa.int64()) for c in (x.a.counts, x.b.counts, x.n_groups, x.n_links)],
                        pa.array(groups_text(pair, x), pa.string()),
                        pa.array([number] * (e - s), pa.int64()),
                        pa.array(links, pa.binary()),
                        list_of(np.r_[0, np.full(e - s, len(a))], entries, first),
                    ],
                    names=["doc", *_COUNTS, "groups", "block", "links", "pairs"],
                )
                number += 1

    return rows.mapInArrow(blocks, schema)


def pair_counts(requests: DataFrame) -> DataFrame:
    """(a, b, n, best): links of the corpus that hold the ids, and whether that is the highest count of the B id.

    The highest counts are a row for each id of B's vocabulary, which bounds what is broadcast.
    """
    counts = staged(requests.groupBy("a", "b").agg(F.sum("n").alias("n")), "pair-counts")
    most = counts.groupBy("b").agg(F.max("n").alias("most"))
    return counts.join(F.broadcast(most), "b").select("a", "b", "n", (F.col("n") == F.col("most")).alias("best"))


def _sums(kept: list[str]) -> Callable[[pa.Table, pa.Table], pa.Table]:
    def of_block(rows: pa.Table, pairs: pa.Table) -> pa.Table:
        place = np.asarray(pairs.column("place"))
        n, best = np.zeros(len(place), np.int64), np.zeros(len(place), np.int64)
        n[place], best[place] = np.asarray(pairs.column("n")), np.asarray(pairs.column("best")).astype(np.int64)
        n_best, count_sum = [], []
        for data in rows.column("links").to_pylist():
            steps, times = unpack(data, 2)
            places = np.cumsum(steps)
            n_best.append(int((best[places] * times).sum()))
            count_sum.append(int((n[places] * times).sum()))
        out = rows.select(kept)
        return out.append_column("n_best", pa.array(n_best, pa.int64())).append_column(
            "count_sum", pa.array(count_sum, pa.int64())
        )

    return of_block


def scored(rows: DataFrame) -> DataFrame:
    """Rows of :func:`align`, or some columns of them, with ``n_best`` and ``count_sum`` over each row's links.

    They need ``block``, ``links`` and ``pairs``, which the result drops. The rows are written once to the
    shared folder: what is aligned there is not aligned again.
    """
    rows = staged(rows, "aligned")
    pairs = rows.where(F.col("pairs").isNotNull()).select(
        F.col("block").alias("of_block"), F.posexplode("pairs").alias("place", "pair")
    )
    requests = pairs.select("of_block", "place", "pair.a", "pair.b", "pair.n")
    answers = requests.drop("n").join(pair_counts(requests), ["a", "b"]).select("of_block", "place", "n", "best")
    kept = [f for f in rows.schema if f.name not in ("block", "links", "pairs")]
    schema = StructType([*kept, StructField("n_best", LongType()), StructField("count_sum", LongType())])
    texts = rows.drop("pairs").groupBy("block")
    return texts.cogroup(answers.groupBy("of_block")).applyInArrow(_sums([f.name for f in kept]), schema)
