"""Splitting texts into the pieces that byte-level BPE merges within."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator

import regex

END = "<|endoftext|>"

# The published pattern, and the same for texts of ASCII and Latin-1 letters alone, where the faster `re` agrees with it.
PATTERN = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
LATIN = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?[A-Za-zÀ-ÖØ-öø-ÿ]+| ?[0-9]+| ?[^\sA-Za-zÀ-ÖØ-öø-ÿ0-9]+|\s+(?!\S)|\s+")
OTHER = re.compile(r"[^\x00-\x1b\x20-\x7fÀ-ÖØ-öø-ÿ]")
CUT = re.compile(r"(?<=\S) ")
SEGMENT = 1 << 20


def segments(text: str) -> Iterator[str]:
    """Long texts in parts, cut before a space that follows a non-space: no piece ever spans such a place."""
    at = 0
    while len(text) - at > SEGMENT:
        m = CUT.search(text, at + SEGMENT)
        if not m:
            break
        yield text[at : m.start()]
        at = m.start()
    yield text[at:] if at else text


def pieces(text: str) -> list[str]:
    """The pieces of a text without special tokens."""
    out: list[str] = []
    for part in segments(text):
        out += (PATTERN if OTHER.search(part) else LATIN).findall(part)
    return out


def split_specials(text: str) -> list[str]:
    """Parts between occurrences of the special token."""
    return text.split(END) if END in text else [text]


def all_pieces(text: str) -> list[str]:
    """Pieces of a text; each occurrence of the special token is a piece of its own."""
    parts = split_specials(text)
    out = pieces(parts[0])
    for part in parts[1:]:
        out.append(END)
        out += pieces(part)
    return out


class PieceCache:
    """What was made of recent pieces, in two generations of bounded size."""

    def __init__(self, make: Callable[[list[str]], Iterable], limit: int = 200_000) -> None:
        self.make, self.limit, self.new, self.old = make, limit, {}, {}

    def fill(self, wanted: Iterable[str]) -> dict:
        """A mapping that has every piece wanted."""
        if len(self.new) > self.limit:
            self.old, self.new = self.new, {}
        new, old, missing = self.new, self.old, []
        for p in set(wanted):
            if p not in new:
                if p in old:
                    new[p] = old[p]
                else:
                    missing.append(p)
        if missing:
            new.update(zip(missing, self.make(missing), strict=True))
        return new
