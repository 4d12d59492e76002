"""Cutting texts into pieces that a byte-level BPE tokenizer treats independently.

A single space between two characters that are not white space always
starts a new pre-token, so a text may be cut there: each later piece is
tokenized with its space in front, independent of its neighbours.  Pieces
repeat across texts, so each distinct piece is tokenized once per worker
(``Interner``).
"""

from __future__ import annotations

import re

import regex

# fixed values: white space as the tokenizer's regular expressions see it, and the two published split patterns
_WS = r"\t-\r \x85\xa0  -     　"
BYTE_PATTERN = regex.compile(
    rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{_WS}\p{{L}}\p{{N}}]+|[{_WS}]+(?![^{_WS}])|[{_WS}]+")
WORD_PATTERN = regex.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|\p{{L}}+|\p{{N}}|[^{_WS}\p{{L}}\p{{N}}]+")
WORD_BREAK = regex.compile(rf"[{_WS}]+")

#: a space beside other white space (plain searches for these few pairs are much cheaper than one pattern)
_BESIDE = [pair for c in map(chr, range(0x3001)) if c.isspace() for pair in ((c + " ", " " + c) if c != " " else ("  ",))]
_ASCII_BESIDE = [pair for pair in _BESIDE if pair.isascii()]
_LONE_SPACE = re.compile(r"(?<=\S) (?=\S)")

#: a worker forgets its pieces beyond this many (a bound on memory, never on results)
MAX_PIECES = 150_000


def space_pieces(text: str) -> list[str]:
    """Pieces of a text; all but the first stand after one space."""
    beside = _ASCII_BESIDE if text.isascii() else _BESIDE
    if text[:1] == " " or text[-1:] == " " or any(pair in text for pair in beside):
        return _LONE_SPACE.split(text)
    return text.split(" ")


def around_specials(text: str, pattern: re.Pattern | None) -> list[tuple[str, str | None]]:
    """(ordinary text, special string after it or None)."""
    if pattern is None or "<|" not in text:
        return [(text, None)]
    out, at = [], 0
    for m in pattern.finditer(text):
        out.append((text[at:m.start()], m.group()))
        at = m.end()
    out.append((text[at:], None))
    return out


def special_pattern(specials: dict[str, int]) -> re.Pattern | None:
    return re.compile("|".join(map(re.escape, sorted(specials, key=len, reverse=True)))) if specials else None


class Interner(dict):
    """Piece -> number; pieces not seen before are queued in ``new``."""

    def __init__(self) -> None:
        super().__init__()
        self.new: list[str] = []

    def __missing__(self, piece: str) -> int:
        i = self[piece] = len(self)
        self.new.append(piece)
        return i


def byte_alphabet() -> dict[int, str]:
    """The published byte-to-character map: printable bytes stand for themselves, the others from U+0100 on."""
    keep = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    table = {b: chr(b) for b in keep}
    for b in range(256):
        if b not in table:
            table[b] = chr(256 + len(table) - len(keep))
    return table
