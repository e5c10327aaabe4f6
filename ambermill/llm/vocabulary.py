"""Byte-level BPE vocabularies: symbols, labels and ranked merges of a tokenizer file."""

from __future__ import annotations

import json
from functools import lru_cache

import public_tokenizers

DEFAULT = "byte_bpe_50k.json"


def tokenizer_path(name_or_path: str = DEFAULT) -> str:
    return name_or_path if "/" in name_or_path else public_tokenizers.path(name_or_path)


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in the file: printable bytes for themselves, the rest from U+0100 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Vocabulary:
    """labels[id]: bytes; byte_id[b]: id; merges[k] = (left id, right id, merged id), by rank."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as f:
            data = json.load(f)
        letters = byte_letters()
        ids: dict[str, int] = data["model"]["vocab"]
        self.size = 1 + max([*ids.values(), *(t["id"] for t in data.get("added_tokens", ()))])
        self.labels: list[bytes] = [b""] * self.size
        for s, i in ids.items():
            self.labels[i] = bytes(letters[c] for c in s)
        self.specials = {t["content"]: t["id"] for t in data.get("added_tokens", ())}
        for s, i in self.specials.items():
            self.labels[i] = s.encode()
        self.byte_id = [0] * 256
        for c, b in letters.items():
            self.byte_id[b] = ids[c]
        self.merges: list[tuple[int, int, int]] = []
        for m in data["model"]["merges"]:
            left, right = m.split(" ") if isinstance(m, str) else m
            self.merges.append((ids[left], ids[right], ids[left + right]))


@lru_cache(maxsize=4)
def load(name_or_path: str = DEFAULT) -> Vocabulary:
    return Vocabulary(tokenizer_path(name_or_path))
