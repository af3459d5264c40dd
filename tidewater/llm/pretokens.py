"""Texts cut into pre-tokens by the byte-level vocabularies' pattern."""

from __future__ import annotations

import re

import regex

from tidewater.llm.bpe import NEWER, PATTERN

# The faster library knows the classes of code points below U+0250 when they are spelled out.
_LOW = re.compile(r"[\0-ɏ]*").fullmatch
_LOW_CLASSES = {
    r"[^\s\p{L}\p{N}]": "[^{s}{l}{n}]",
    r"\p{L}": "[{l}]",
    r"\p{N}": "[{n}]",
    r"\S": "[^{s}]",
    r"\s": "[{s}]",
}


def _low_pattern() -> str:
    out = PATTERN
    for general, spelled in _LOW_CLASSES.items():
        out = out.replace(general, spelled)
    return out.format(s=r"\t-\r \x85\xa0", l="A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-ɏ", n="0-9\xb2\xb3\xb9\xbc-\xbe")


def _older_pattern() -> str:
    """Code points that newer Unicode versions assigned count as neither letters nor numbers."""
    newer = f"[{NEWER}]"
    out = PATTERN.replace(r"[^\s\p{L}\p{N}]", rf"(?:{newer}|[^\s\p{{L}}\p{{N}}])")
    for kind in ("L", "N"):
        out = out.replace(rf" ?\p{{{kind}}}+", rf" ?(?:(?!{newer})\p{{{kind}}})+")
    return out


_low_words = re.compile(_low_pattern()).findall
_words = regex.compile(PATTERN).findall
_older_words = regex.compile(_older_pattern()).findall
_has_newer = regex.compile(f"[{NEWER}]").search


def cut(text: str) -> list[str]:
    """All matches of the pattern, which together are the text."""
    if _LOW(text):
        return _low_words(text)
    return (_older_words if _has_newer(text) else _words)(text)
