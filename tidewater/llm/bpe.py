"""Byte-level BPE: whole texts to token ids, and token ids to text.

Encoding cuts a text into words by the tokenizer's pattern and merges the words of a
batch together: their symbols lie in one flat array, each round looks up all
neighbouring pairs by binary search over the sorted pair keys, and merges in every word
its pair of lowest rank. A worker keeps the ids of words it has seen, up to a bound.

Null text gives null ids and null ids give null text; an empty text gives no ids. Texts
are never truncated; the string of a special token within a text becomes its id, as the
vocabulary's library does. Rows are independent, so repeated rows, hot sources and extra
columns have no influence.
"""

from __future__ import annotations

import functools
import itertools
import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column
from pyspark.sql import functions as F

from tidewater.llm.arrow import list_of, ranges
from tidewater.llm.words import pieces

# The words of the vocabulary's byte-level pattern.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

# Letters and numbers of Unicode versions after 16, which the
# vocabulary's library takes as unassigned.
NEWER = (
    "՘֋-֌࢏౜೜₏₝-₟꟎-꟏꟒꟔꟝꟢꟱"
    "꭬-꭭\U000107bb-\U000107bf\U00010940-\U00010959\U00010ec5-\U00010ec7\U00010ed9-\U00010eee"
    "\U00011b0a\U00011db0-\U00011ddb\U00011de0-\U00011de9\U00011df1\U0001246f\U00012475-\U0001247f"
    "\U00012550-\U00012686\U00016ea0-\U00016eb8\U00016ebb-\U00016ed3\U00016ff2-\U00016ff6"
    "\U000187f8-\U000187ff\U00018cd6-\U00018cda\U00018d09-\U00018d20\U00018d80-\U00018df2"
    "\U00018e00-\U00019191\U000191a0-\U000191d2\U0001b123-\U0001b128\U0001b168\U0001d6a6"
    "\U0001df1f-\U0001df24\U0001df2b-\U0001df81\U0001df90-\U0001df96\U0001dfcd-\U0001dfff"
    "\U0001e6c0-\U0001e6de\U0001e6e0-\U0001e6e2\U0001e6e4-\U0001e6e5\U0001e6e7-\U0001e6ed"
    "\U0001e6f0-\U0001e6f4\U0001e6fe-\U0001e6ff\U0002b73a-\U0002b73f\U0002b81e\U0002cea2-\U0002cead"
    "\U000323b0-\U00033479\U0003d000-\U0003fc3f"
)

# Words and ids that a worker keeps; beyond that it starts anew.
KEPT_WORDS = 400_000
KEPT_IDS = 4_000_000
# New words that are merged at once.
MERGED = 10_000
# Ids that are decoded at once. A longer row is taken alone.
DECODED = 400_000


def _byte_chars() -> dict[str, int]:
    """The printable character that stands for each byte in a vocabulary file."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


# The same pattern for texts without code points from U+0250, for the faster library.
_LATIN = re.compile(r"[\0-\u024f]*").fullmatch
_LATIN_WORDS = re.compile(
    PATTERN.replace(r"[^\s\p{L}\p{N}]", "[^{s}{l}{n}]")
    .replace(r"\p{L}", "[{l}]")
    .replace(r"\p{N}", "[{n}]")
    .replace(r"\S", "[^{s}]")
    .replace(r"\s", "[{s}]")
    .format(s=r"\t-\r \x85\xa0", l="A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\u024f", n="0-9\xb2\xb3\xb9\xbc-\xbe")
).findall


class _Numbers(dict):
    """Numbers of words; a word that is asked for the first time gets the next one."""

    def __init__(self, words):
        super().__init__((w, i) for i, w in enumerate(words))
        self.new: list[str] = []

    def __missing__(self, word: str) -> int:
        self.new.append(word)
        self[word] = n = len(self)
        return n

    def take(self) -> list[str]:
        new, self.new = self.new, []
        return new


class ByteBPE:
    """A vocabulary file, and the words seen so far."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        chars = _byte_chars()
        vocab = spec["model"]["vocab"]
        special = {x["content"]: x["id"] for x in spec["added_tokens"]}
        self.special = special
        self.split = regex.compile("|".join(map(regex.escape, sorted(special, key=len, reverse=True)))) if special else None
        newer = f"[{NEWER}]"
        self.words = regex.compile(PATTERN)
        self.newer = regex.compile(newer)
        self.words_strict = regex.compile(
            PATTERN.replace(r"[^\s\p{L}\p{N}]", rf"(?:{newer}|[^\s\p{{L}}\p{{N}}])")
            .replace(r" ?\p{L}+", rf" ?(?:(?!{newer})\p{{L}})+")
            .replace(r" ?\p{N}+", rf" ?(?:(?!{newer})\p{{N}})+")
        )
        self.byte_id = np.zeros(256, np.int64)
        for c, b in chars.items():
            self.byte_id[b] = vocab[c]
        pairs = np.array([(vocab[a], vocab[b], vocab[a + b]) for a, b in spec["model"]["merges"]], np.int64)
        keys = pairs[:, 0] << 32 | pairs[:, 1]
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks, self.merged = keys[order], order, pairs[order, 2]
        tokens: list[bytes] = [b""] * (max([*vocab.values(), *special.values()]) + 1)
        for token, i in vocab.items():
            tokens[i] = bytes(chars[c] for c in token)
        for token, i in special.items():
            tokens[i] = token.encode()
        self.token_len = np.array([len(t) for t in tokens], np.int64)
        self.token_at = np.cumsum(self.token_len) - self.token_len
        self.token_bytes = np.frombuffer(b"".join(tokens), np.uint8)
        self._forget()

    def _forget(self) -> None:
        """Keep only the special tokens' own ids."""
        self.seen = _Numbers("\0" + token for token in self.special)
        self.seen_ids = np.array(list(self.special.values()), np.int32)
        self.seen_at = np.arange(len(self.seen))
        self.seen_len = np.ones(len(self.seen), np.int64)

    def _pairs(self, symbols: np.ndarray, word: np.ndarray, left: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Place among the sorted keys, and rank, of the pairs that begin at ``left``."""
        at, rank = np.full(len(left), -1), np.full(len(left), len(self.keys))
        inside = np.flatnonzero(left < len(symbols) - 1)
        inside = inside[word[left[inside]] == word[left[inside] + 1]]
        pair = symbols[left[inside]] << 32 | symbols[left[inside] + 1]
        found = np.minimum(np.searchsorted(self.keys, pair), len(self.keys) - 1)
        hit = self.keys[found] == pair
        at[inside[hit]], rank[inside[hit]] = found[hit], self.ranks[found[hit]]
        return at, rank

    def merge(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words in one array, and how many belong to each word."""
        lengths = np.array([len(w) for w in words], np.int64)
        symbols = self.byte_id[np.frombuffer(b"".join(words), np.uint8)]
        word = np.repeat(np.arange(len(words)), lengths)
        at, rank = self._pairs(symbols, word, np.arange(len(symbols)))
        done_symbols, done_words = [], []
        no_rank = len(self.keys)
        while len(symbols):
            starts = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
            lowest = np.minimum.reduceat(rank, starts)
            lowest = np.repeat(lowest, np.diff(np.r_[starts, len(word)]))
            over = lowest == no_rank
            if over.any():
                done_symbols.append(symbols[over])
                done_words.append(word[over])
                go = ~over
                symbols, word, at, rank, lowest = symbols[go], word[go], at[go], rank[go], lowest[go]
                if not len(symbols):
                    break
            chosen = rank == lowest
            # In a run of overlapping pairs (a a a) every other one is merged, from the left.
            if (chosen[:-1] & chosen[1:]).any():
                place = np.arange(len(chosen))
                before = np.maximum.accumulate(np.where(chosen, -1, place))
                chosen &= (place - before) % 2 == 1
            left = np.flatnonzero(chosen)
            symbols[left] = self.merged[at[left]]
            stay = np.ones(len(symbols), bool)
            stay[left + 1] = False
            symbols, word, at, rank = symbols[stay], word[stay], at[stay], rank[stay]
            # Only the pairs on either side of a merged symbol are new.
            new = left - np.arange(len(left))
            touched = np.zeros(len(symbols) + 1, bool)
            touched[new], touched[new - 1] = True, True  # the last place takes what precedes the first
            near = np.flatnonzero(touched[:-1])
            at[near], rank[near] = self._pairs(symbols, word, near)
        if not done_symbols:
            return np.zeros(0, np.int32), lengths
        symbols, word = np.concatenate(done_symbols), np.concatenate(done_words)
        order = np.argsort(word, kind="stable")
        return symbols[order].astype(np.int32), np.bincount(word, minlength=len(words))

    def _learn(self, words: list[str]) -> None:
        parts = [self.merge([w.encode() for w in words[a : a + MERGED]]) for a in range(0, len(words), MERGED)]
        counts = np.concatenate([n for _, n in parts])
        self.seen_at = np.concatenate([self.seen_at, np.cumsum(counts) - counts + len(self.seen_ids)])
        self.seen_len = np.concatenate([self.seen_len, counts])
        self.seen_ids = np.concatenate([self.seen_ids, *[ids for ids, _ in parts]])

    def _cut(self, text: str) -> list[str]:
        if _LATIN(text):
            return _LATIN_WORDS(text)
        return (self.words_strict if self.newer.search(text) else self.words).findall(text)

    def _pieces(self, text: str) -> list[str]:
        if self.split is None or not self.split.search(text):
            return self._cut(text)
        out, at = [], 0
        for m in self.split.finditer(text):
            out += self._cut(text[at : m.start()])
            out.append("\0" + m[0])  # no word begins with \0 and holds the string of a special token
            at = m.end()
        return out + self._cut(text[at:])

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in one array, and how many belong to each text; words are held for some texts at a time."""
        parts = [self._encode(texts[a:b]) for a, b in pieces(texts)]
        if not parts:
            return np.zeros(0, np.int32), np.zeros(0, np.int64)
        return np.concatenate([ids for ids, _ in parts]), np.concatenate([counts for _, counts in parts])

    def _encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        if len(self.seen) > KEPT_WORDS or len(self.seen_ids) > KEPT_IDS:
            self._forget()
        words = [self._pieces(t) if t else [] for t in texts]
        n_words = np.fromiter(map(len, words), np.int64, len(words))
        flat = itertools.chain.from_iterable(words)
        known = np.fromiter(map(self.seen.__getitem__, flat), np.int64, int(n_words.sum()))
        if self.seen.new:
            self._learn(self.seen.take())
        lengths = self.seen_len[known]
        ids = self.seen_ids[ranges(self.seen_at[known], lengths)]
        ends = np.r_[0, np.cumsum(lengths)][np.cumsum(n_words)]
        return ids, np.diff(np.r_[0, ends])

    def decode(self, ids: np.ndarray, counts: np.ndarray) -> list[str]:
        """The text of each row's ids; bytes that are no UTF-8 become U+FFFD. Rows of about DECODED ids are taken at a time."""
        out: list[str] = []
        ends = np.cumsum(counts)
        first, at = 0, 0
        while first < len(counts):
            last = max(first + 1, int(np.searchsorted(ends, at + DECODED, side="right")))
            part = ids[at : ends[last - 1]]
            lengths = self.token_len[part]
            data = self.token_bytes[ranges(self.token_at[part], lengths)].tobytes()
            stops = np.r_[0, np.cumsum(lengths)][ends[first:last] - at].tolist()
            out += [data[a:b].decode("utf-8", "replace") for a, b in zip([0, *stops], stops)]
            first, at = last, int(ends[last - 1])
        return out


@functools.cache
def tokenizer(path: str) -> ByteBPE:
    """The vocabulary of a file, loaded once by each worker."""
    return ByteBPE(path)


def encode(text: Column, path: str) -> Column:
    """Token ids (array<int>) of a text column, by the vocabulary file at ``path``."""

    def ids(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        bpe = tokenizer(path)
        for texts in batches:
            flat, counts = bpe.encode(texts.to_pylist())
            valid = ~np.asarray(texts.is_null())
            yield list_of(np.r_[0, np.cumsum(counts)], pa.array(flat, pa.int32()), valid)

    ids.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return F.arrow_udf(ids, "array<int>")(text)


def decode(ids: Column, path: str) -> Column:
    """The text of token ids, by the vocabulary file at ``path``."""

    def texts(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        bpe = tokenizer(path)
        for rows in batches:
            counts = np.asarray(rows.value_lengths().fill_null(0)).astype(np.int64)
            out = bpe.decode(np.asarray(rows.flatten()).astype(np.int64), counts)
            yield pa.array([None if null else t for null, t in zip(rows.is_null().to_pylist(), out)], pa.string())

    texts.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return F.arrow_udf(texts, "string")(ids)


def coded(text: Column, path: str) -> Column:
    """Token ids of a text column and the text of these ids (struct<ids:array<int>,decoded:string>).

    As :func:`encode` and :func:`decode` after each other, but by one Python worker for each task instead of two.
    """

    def both(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        bpe = tokenizer(path)
        for texts in batches:
            flat, counts = bpe.encode(texts.to_pylist())
            valid = ~np.asarray(texts.is_null())
            ids = list_of(np.r_[0, np.cumsum(counts)], pa.array(flat, pa.int32()), valid)
            decoded = [t if v else None for v, t in zip(valid.tolist(), bpe.decode(flat.astype(np.int64), counts))]
            yield pa.StructArray.from_arrays([ids, pa.array(decoded, pa.string())], ["ids", "decoded"])

    both.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return F.arrow_udf(both, "struct<ids:array<int>,decoded:string>")(text)
