"""Vectorised 64-bit hashes of words and word n-grams in UTF-8 text."""

from __future__ import annotations

import numpy as np

MASK = (1 << 64) - 1
LONGEST = 1 << 12


def splitmix(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64, on uint64 arrays."""
    x = x + np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


BYTE_CODE = splitmix(np.arange(256, dtype=np.uint64) + np.uint64(1))
PLACE_CODE = splitmix(np.arange(LONGEST, dtype=np.uint64) + np.uint64(1 << 20)) | np.uint64(1)

# 0: white space (space, tab to carriage return); 1: anything else
WORDS = np.ones(256, np.uint8)
WORDS[[32, *range(9, 14)]] = 0
# as above, with ASCII punctuation as a kind of word of its own
SHAPES = WORDS.copy()
SHAPES[[b for b in range(33, 127) if not chr(b).isalnum() and chr(b) not in "_'"]] = 2
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def word_hashes(data: np.ndarray, kinds: np.ndarray = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each word, its first byte) of a byte array. A word is a run of bytes of one kind other than 0."""
    kind = kinds[data]
    first = kind > 0
    first[1:] &= kind[1:] != kind[:-1]
    start = np.flatnonzero(first)
    if not len(start):
        return np.empty(0, np.uint64), start
    inside = kind > 0
    number = np.cumsum(first) - 1
    place = np.arange(len(data)) - start[np.maximum(number, 0)]
    code = BYTE_CODE[data] * PLACE_CODE[place % LONGEST] + (place // LONGEST).astype(np.uint64)
    code[~inside] = 0
    return splitmix(np.add.reduceat(code, start)), start


def shingle_hashes(words: np.ndarray, width: int) -> np.ndarray:
    """Hash of each run of `width` words; with fewer words, of the whole as one; none without words."""
    if not len(words):
        return words
    width = min(width, len(words))
    n = len(words) - width + 1
    h = np.full(n, width, np.uint64)
    for i in range(width):
        h = splitmix(h ^ words[i : i + n])
    return h


def text_batches(texts: list[str], lower: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """All texts as one byte array, a newline after each, and where each starts."""
    raw = [t.encode() for t in texts]
    starts = np.cumsum([0] + [len(r) + 1 for r in raw])
    data = np.frombuffer(b"\n".join(raw) + b"\n", dtype=np.uint8)
    return (LOWER[data] if lower else data), starts
