"""Byte-level BPE of a rank file by a sentencepiece model that is written from it.

Every byte stands for one printable character, so a token of any bytes is a piece of text. The
model's pieces are the vocabulary's tokens in the order of their ranks, each scored by its
negative rank: of two neighbouring symbols that form a piece, sentencepiece joins those of the highest score
first, the leftmost of equals, which is the merge order of the ranks. Its normalisation is the
identity: no space is added, removed or marked. A text is cut by the vocabulary's pattern, each
distinct pre-token of a worker is encoded once, and a pre-token that is itself a token is that token, also
if merges would not lead to it. Token ids become bytes again by the inverse of the byte mapping.

Null text gives null ids, and null ids give null bytes; an empty text gives no ids. Texts are never
truncated, and strings of special tokens are plain text: the rank file has none. Decoding gives
bytes, which need not be UTF-8 when ids are not those of a text; ids outside the vocabulary
are refused (IndexError). Rows are independent, so ties, repeated rows, hot sources and extra columns have
no influence; an empty table gives an empty result.
"""

from __future__ import annotations

import base64
import functools
import itertools
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import Column
from pyspark.sql import functions as F

from tidewater.llm.arrow import list_of, ranges
from tidewater.llm.pretokens import cut
from tidewater.llm.words import pieces

# Pre-tokens and ids that a worker keeps; beyond that it starts anew.
KEPT_WORDS = 400_000
KEPT_IDS = 4_000_000
# Ids that are decoded at once, one row at least.
DECODED = 250_000

# One character per byte, none of them white space, a control or U+2581, which sentencepiece treats apart.
FIRST_CHAR = 0x100
_CHARS = {b: chr(FIRST_CHAR + b) for b in range(256)}
_UNKNOWN = "⁇"

# Field numbers and enumerations of the sentencepiece model format.
_PIECES, _TRAINER, _NORMALIZER = 1, 2, 3
_PIECE, _SCORE, _TYPE = 1, 2, 3
_NORMAL, _IS_UNKNOWN, _UNUSED = 1, 2, 5
_MODEL_TYPE, _VOCAB_SIZE, _UNK_ID, _BOS_ID, _EOS_ID, _PAD_ID, _UNK_PIECE, _BPE = 3, 4, 40, 41, 42, 43, 45, 2
_NAME, _DUMMY_PREFIX, _EXTRA_SPACES, _ESCAPE = 1, 3, 4, 5


def _varint(n: int) -> bytes:
    n &= (1 << 64) - 1
    out = bytearray()
    while n > 0x7F:
        out.append(n & 0x7F | 0x80)
        n >>= 7
    out.append(n)
    return bytes(out)


def _number(field: int, n: int) -> bytes:
    return _varint(field << 3) + _varint(n)


def _bytes(field: int, data: bytes) -> bytes:
    return _varint(field << 3 | 2) + _varint(len(data)) + data


def _float(field: int, x: float) -> bytes:
    return _varint(field << 3 | 5) + struct.pack("<f", x)


def _piece(text: str, score: float, kind: int) -> bytes:
    return _bytes(_PIECES, _bytes(_PIECE, text.encode()) + _float(_SCORE, score) + _number(_TYPE, kind))


def read_ranks(path: str) -> dict[bytes, int]:
    """Tokens and ranks of a file with one base64 token and its rank in each line."""
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, filter(bytes.strip, f))}


def as_piece(token: bytes) -> str:
    """The characters that stand for bytes."""
    return token.decode("latin-1").translate(_CHARS)


def as_bytes(piece: str) -> bytes:
    """The bytes that characters stand for."""
    return bytes(ord(c) - FIRST_CHAR for c in piece)


def model(ranks: dict[bytes, int]) -> bytes:
    """A sentencepiece BPE model whose piece i is the token of rank i.

    All 256 single bytes must be tokens. Ranks that no token has are held by unused pieces, and
    the unknown piece that the format asks for follows the last rank.
    """
    missing = [b for b in range(256) if bytes([b]) not in ranks]
    if missing:
        raise ValueError(f"no tokens for the bytes {missing[:8]}")
    by_rank = {rank: token for token, rank in ranks.items()}
    size = max(by_rank) + 1
    pieces = [
        _piece(as_piece(by_rank[i]), -float(i), _NORMAL) if i in by_rank else _piece(f"{_UNKNOWN}{i}", -float(i), _UNUSED)
        for i in range(size)
    ]
    pieces.append(_piece(_UNKNOWN, 0.0, _IS_UNKNOWN))
    trainer = _number(_MODEL_TYPE, _BPE) + _number(_VOCAB_SIZE, size + 1) + _number(_UNK_ID, size)
    trainer += b"".join(_number(field, -1) for field in (_BOS_ID, _EOS_ID, _PAD_ID)) + _bytes(_UNK_PIECE, _UNKNOWN.encode())
    normalizer = _bytes(_NAME, b"identity") + b"".join(_number(field, 0) for field in (_DUMMY_PREFIX, _EXTRA_SPACES, _ESCAPE))
    return b"".join(pieces) + _bytes(_TRAINER, trainer) + _bytes(_NORMALIZER, normalizer)


class _Numbers(dict):
    """Words numbered in the order in which they are first asked for."""

    def __missing__(self, word: str) -> int:
        self[word] = n = len(self)
        return n


class BytePieces:
    """The model of a rank file, and the pre-tokens encoded so far."""

    def __init__(self, ranks: dict[bytes, int]):
        self.pieces = sentencepiece.SentencePieceProcessor(model_proto=model(ranks))
        self.whole = {as_piece(token): rank for token, rank in ranks.items()}
        size = max(ranks.values()) + 1
        tokens = [b""] * size
        for piece, i in self.whole.items():
            tokens[i] = as_bytes(piece)
        self.token_len = np.array([len(t) for t in tokens], np.int64)
        self.token_at = np.cumsum(self.token_len) - self.token_len
        self.token_bytes = np.frombuffer(b"".join(tokens), np.uint8)
        self._forget()

    def _forget(self) -> None:
        self.numbers = _Numbers()
        self.ids, self.at, self.len = np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def encode_words(self, words: list[str]) -> list[list[int]]:
        """Ids of each pre-token."""
        mapped = [as_piece(w.encode()) for w in words]
        ids = [[self.whole[m]] if m in self.whole else None for m in mapped]
        rest = [i for i, known in enumerate(ids) if known is None]
        for i, found in zip(rest, self.pieces.encode([mapped[i] for i in rest], num_threads=1) if rest else []):
            ids[i] = found
        return ids

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in one array, and how many belong to each text."""
        if len(self.numbers) > KEPT_WORDS or len(self.ids) > KEPT_IDS:
            self._forget()
        words = [cut(t) if t else [] for t in texts]
        n_words = np.fromiter(map(len, words), np.int64, len(words))
        known = len(self.numbers)
        places = np.fromiter(
            map(self.numbers.__getitem__, itertools.chain.from_iterable(words)), np.int64, int(n_words.sum())
        )
        if len(self.numbers) > known:
            new = self.encode_words(list(itertools.islice(self.numbers, known, None)))
            lengths = np.fromiter(map(len, new), np.int64, len(new))
            self.at = np.concatenate([self.at, np.cumsum(lengths) - lengths + len(self.ids)])
            self.len = np.concatenate([self.len, lengths])
            flat = np.fromiter(itertools.chain.from_iterable(new), np.int32, int(lengths.sum()))
            self.ids = np.concatenate([self.ids, flat])
        lengths = self.len[places]
        ids = self.ids[ranges(self.at[places], lengths)]
        ends = np.r_[0, np.cumsum(lengths)][np.cumsum(n_words)]
        return ids, np.diff(np.r_[0, ends])

    def decode(self, ids: np.ndarray, counts: np.ndarray) -> list[bytes]:
        """The bytes of each row's ids."""
        if len(ids) and not 0 <= ids.min() <= ids.max() < len(self.token_len):
            raise IndexError("an id is not in the vocabulary")
        lengths = self.token_len[ids]
        data = self.token_bytes[ranges(self.token_at[ids], lengths)].tobytes()
        ends = np.r_[0, np.cumsum(lengths)][np.cumsum(counts)].tolist()
        return [data[a:b] for a, b in zip([0, *ends], ends)]

    def decode_rows(self, ids: np.ndarray, counts: np.ndarray) -> Iterator[bytes]:
        """As :func:`decode`, some rows at a time."""
        ends = np.cumsum(counts)
        first = 0
        while first < len(counts):
            start = ends[first] - counts[first]
            last = max(first + 1, int(np.searchsorted(ends, start + DECODED, side="right")))
            yield from self.decode(ids[start : ends[last - 1]], counts[first:last])
            first = last


@functools.cache
def byte_pieces(path: str) -> BytePieces:
    """The model of a rank file, written and loaded once by each worker."""
    return BytePieces(read_ranks(path))


def encode(text: Column, path: str) -> Column:
    """Token ids (array<int>) of a text column, by the rank file at ``path``."""

    def ids(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own = byte_pieces(path)
        for column in batches:
            texts = column.to_pylist()
            # Lists of words are held for some of a batch's texts at once.
            parts = [own.encode(texts[a:b]) for a, b in pieces(texts)] or [own.encode([])]
            flat, counts = (np.concatenate(x) for x in zip(*parts))
            yield list_of(np.r_[0, np.cumsum(counts)], pa.array(flat, pa.int32()), ~np.asarray(column.is_null()))

    ids.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return F.arrow_udf(ids, "array<int>")(text)


def decode(ids: Column, path: str) -> Column:
    """The bytes (binary) of token ids, by the rank file at ``path``; null for a row that holds a null id."""

    def data(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own = byte_pieces(path)
        for rows in batches:
            counts = np.asarray(rows.value_lengths().fill_null(0)).astype(np.int64)
            flat = rows.flatten()
            holes = np.asarray(flat.is_null())
            out = own.decode_rows(np.asarray(flat.fill_null(0)).astype(np.int64), counts)
            seen = np.r_[0, np.cumsum(holes)]
            ends = np.cumsum(counts)
            null = np.asarray(rows.is_null()) | (seen[ends] > seen[ends - counts])
            yield pa.array([None if n else d for n, d in zip(null.tolist(), out)], pa.binary())

    data.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return F.arrow_udf(data, "binary")(ids)
