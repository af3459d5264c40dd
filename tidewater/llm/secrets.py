"""Secret scan by assignment-aware lexing.

A text is read as source code or configuration: each ``name = literal``, ``name: literal``, ``name: type = literal``
or ``name => literal`` gives a name-literal pair. A literal is a quoted string, also with a prefix
(``b"..."``) or in triple quotes and with blanks in it, or a bare run of characters up to a blank, a quote, a bracket or one of
``,;&``. A name that is assigned another name holds what any assignment of that one gives it, wherever in
the text it stands and over any number of steps (constants are propagated to a fixed point); a bare word that no
assignment of the text names is a literal itself. A literal is scored by the most sensitive of the names that hold it,
by its length and by the variety of its characters. Token formats that need no name (fixed patterns
below) are found beside the pairs.

``scan`` gives all spans of a text. Null and empty texts have none. Whole texts are read,
whatever their length, in time that grows with it: bare literals of one run (``a=b=c``) end at one place, which is looked
for once, and are counted from the last to the first. Rows are independent, so repeated rows get equal results.
"""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

SPANS = "array<struct<kind:string,start:int,end:int,score:double>>"

# The kinds of base spans in the order in which ties are listed, their
# patterns, which group must be how long.
BASE = [
    (
        "assign",
        re.compile(
            r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
            re.ASCII | re.IGNORECASE,
        ),
        2,
        8,
    ),
    ("access", re.compile(r"AKIA[A-Z0-9]+"), 0, 16),
    ("hex", re.compile(r"[0-9a-f]{32,}"), 0, 32),  # maximal runs, so the bound may stand in the pattern
]

# Words of names that hold secrets, and their weight.
SENSITIVE = {
    "password": 1.0, "passwd": 1.0, "pwd": 1.0, "passphrase": 1.0, "secret": 1.0, "token": 0.9,
    "apikey": 1.0, "credential": 0.9, "credentials": 0.9, "auth": 0.6, "bearer": 0.8, "signature": 0.5,
    "privatekey": 1.0, "accesskey": 1.0, "secretkey": 1.0, "encryptionkey": 1.0, "connectionstring": 0.8,
}
KEY_OF = {"api", "access", "private", "secret", "encryption", "signing", "master", "auth", "client", "account"}

MIN_LENGTH = 8
MIN_SCORE = 0.75

_OPERATOR = re.compile(r"=>|:=|[:=](?![:=])")
# Name and type before an equals sign; the bound on a type's arguments keeps the search linear.
_ANNOTATED = re.compile(
    r"""(?<![\w$])(?P<name>[A-Za-z_$][\w$]*+)[ \t]*+(?P<colon>:)[ \t]*+[A-Za-z_][\w.]*+(?:\[[^\]\n=]{0,200}+\])?+"""
    r"""(?:[ \t]*+\|[ \t]*+[A-Za-z_][\w.]*+)*+[ \t]*+=(?!=)"""
)
_BLANKS = re.compile(r"[ \t]*+")
_QUOTE = re.compile(r"""[rRbBuUfF]{0,2}+(?P<q>\"{3}|'{3}|["'`])""")
_BODY = {q: re.compile(rf"(?:\\.|[^\\\n{q}])*+") for q in "\"'`"}
_RUN_END = re.compile(r"""[\s"'`,;&(){}\[\]<>]""")
_IDENT = re.compile(r"[A-Za-z_$][\w$]*+(?:\.[A-Za-z_$][\w$]*+)*+")
_WORD = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|\d+")
_NAME_CHARS = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789_$.-")


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Leftmost non-overlapping matches of each base pattern, without those too short."""
    out = []
    for order, (kind, pattern, group, least) in enumerate(BASE):
        for m in pattern.finditer(text):
            if m.end(group) - m.start(group) >= least:
                out.append((m.start(), order, kind, m.end()))
    return [(kind, start, end) for start, _, kind, end in sorted(out)]


def name_score(name: str) -> float:
    """How sensitive a name is, 0 to 1, by its words."""
    words = [w.lower() for w in _WORD.findall(name)]
    best = max((SENSITIVE.get(w, 0.0) for w in words), default=0.0)
    for a, b in zip(words, words[1:]):
        best = max(best, SENSITIVE.get(a + b, 0.0), 0.95 if b in ("key", "keys") and a in KEY_OF else 0.0)
    return best


def _variety(counts: Counter, n: int) -> float:
    bits = -sum(c / n * math.log2(c / n) for c in counts.values() if c)
    used = [c for c, k in counts.items() if k]
    kinds = sum(any(f(c) for c in used) for f in (str.islower, str.isupper, str.isdigit)) + any(
        not c.isalnum() for c in used
    )
    return min(1.0, bits / 4) * (0.5 + 0.25 * min(kinds - 1, 2))


def literal_score(value: str) -> float:
    """How much a literal looks like a random value, 0 to 1: bits a character and classes of characters."""
    return _variety(Counter(value), len(value))


def _name_before(text: str, at: int) -> str:
    """The name that ends before an operator, without what closes a quoted key or an index."""
    while at > 0 and text[at - 1] in " \t":
        at -= 1
    for _ in range(3):
        if at > 0 and text[at - 1] in "\"'`])":
            at -= 1
    start = at
    while start > 0 and text[start - 1] in _NAME_CHARS:
        start -= 1
    return text[start:at]


def _quoted(text: str, m: re.Match) -> tuple[int, int] | None:
    """Start and end of the string that a quote opens; None if nothing closes it."""
    q, start = m["q"], m.end()
    if len(q) == 3:
        end = text.find(q, start)
        return None if end < 0 else (start, end)
    end = _BODY[q].match(text, start).end()
    return (start, end) if text.startswith(q, end) else None


def pairs(text: str) -> Iterator[tuple[str, int, int, bool]]:
    """Name, start and end of the literal, and whether it was quoted, in the order of the operators."""
    annotated = list(_ANNOTATED.finditer(text)) if ":" in text and "=" in text else []
    typed, colons = {m.end(): m["name"] for m in annotated}, {m.start("colon") for m in annotated}
    run_end = 0
    for m in _OPERATOR.finditer(text):
        if m.start() in colons:
            continue
        names = [n for n in (_name_before(text, m.start()), typed.get(m.end())) if n]
        if not names:
            continue
        at = _BLANKS.match(text, m.end()).end()
        quote = _QUOTE.match(text, at)
        if quote:
            found = _quoted(text, quote)
            if found is None:
                continue
        else:
            if at >= run_end:
                stop = _RUN_END.search(text, at)
                run_end = stop.start() if stop else len(text)
            if at >= run_end:
                continue
            found = at, run_end
        for name in names:
            yield name, *found, quote is not None


def _sensitivity(held: dict[str, list], aliases: list[tuple[str, str]]) -> dict[str, float]:
    """How sensitive the literals of each name are: by the name itself and by all names that it is assigned to."""
    out = {name: name_score(name) for name in held}
    to = defaultdict(list)
    for name, other in aliases:
        to[name].append(other)
    waiting = sorted((s, n) for n, s in out.items() if s)
    while waiting:
        score, name = waiting.pop()
        # Names come in falling order of what reaches them, so each is passed on once.
        for other in to.pop(name, ()):
            if out.get(other, 0.0) < score:
                out[other] = score
                waiting.append((score, other))
    return out


def assigned(text: str) -> list[tuple[str, int, int, float]]:
    """Literals that sensitive names hold, directly or through other names."""
    found = list(pairs(text))
    short = lambda name: name.rpartition(".")[2] or name
    names = {short(name) for name, *_ in found}
    held: dict[str, list[tuple[int, int, bool]]] = {n: [] for n in names}
    aliases = []
    full: dict[str, str] = {}
    for name, start, end, quoted in found:
        own = short(name)
        if name_score(name) > name_score(full.get(own, own)):
            full[own] = name
        word = None if quoted else _IDENT.fullmatch(text, start, end)
        other = short(word[0]) if word else None
        if other in held and other != own:
            aliases.append((own, other))
        else:
            held[own].append((start, end, quoted))
    sensitive = _sensitivity({full.get(n, n): x for n, x in held.items()}, [(full.get(a, a), full.get(b, b)) for a, b in aliases])
    best: dict[tuple[int, int], float] = {}
    bare = []
    for own, literals in held.items():
        weight = sensitive.get(full.get(own, own), 0.0)
        for start, end, quoted in literals if weight else ():
            if end - start < MIN_LENGTH:
                continue
            if quoted:
                best[start, end] = max(best.get((start, end), 0.0), 0.5 * weight + 0.5 * literal_score(text[start:end]))
            else:
                bare.append((end, start, weight))
    # Bare literals of one run share their end: counted from the right, each character is looked at once.
    counts, last, at = Counter(), -1, -1
    for end, start, weight in sorted(bare, reverse=True):
        if end != last:
            counts, last, at = Counter(), end, end
        counts.update(text[start:at])
        at = start
        best[start, end] = max(best.get((start, end), 0.0), 0.5 * weight + 0.5 * _variety(counts, end - start))
    return [("literal", a, b, round(s, 6)) for (a, b), s in best.items() if s >= MIN_SCORE]


def spans(text: str | None) -> list[tuple[str, int, int, float]]:
    """All spans of a text by start, base kinds first in their order. Base spans score 1."""
    if not text:
        return []
    kinds = {kind: i for i, (kind, *_) in enumerate(BASE)}
    found = [(kind, a, b, 1.0) for kind, a, b in base_spans(text)]
    if ":" in text or "=" in text:
        found += assigned(text)
    return sorted(found, key=lambda x: (x[1], kinds.get(x[0], len(kinds)), x[2]))


def scan(text: Column) -> Column:
    """All spans of a text column; offsets are code points, ends exclusive."""

    def found(texts: pa.Array) -> pa.Array:
        rows = [
            [{"kind": k, "start": a, "end": b, "score": s} for k, a, b, s in spans(t)] for t in texts.to_pylist()
        ]
        fields = [("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())]
        return pa.array(rows, pa.list_(pa.struct(fields)))

    found.__annotations__ = {"texts": pa.Array, "return": pa.Array}
    return F.arrow_udf(found, SPANS)(text)


def redact(text: Column, found: Column, mask: str = "***") -> Column:
    """The text with each span replaced by a mask; overlapping spans get one mask."""

    def cut(texts: pa.Array, rows: pa.Array) -> pa.Array:
        out = []
        for t, row in zip(texts.to_pylist(), rows.to_pylist()):
            if t is None or not row:
                out.append(t)
                continue
            parts, at = [], 0
            for s in row:
                if s["start"] >= at:
                    parts += [t[at : s["start"]], mask]
                at = max(at, s["end"])
            out.append("".join(parts) + t[at:])
        return pa.array(out, pa.string())

    cut.__annotations__ = {"texts": pa.Array, "rows": pa.Array, "return": pa.Array}
    return F.arrow_udf(cut, "string")(text, found)
