"""Token counts by rank-synchronous merging of ragged arrays.

The pieces of a batch that were not counted lately lie end to end in one array of symbols. Each round looks up the rank of
every adjacent pair, takes the lowest rank of each piece, and applies that merge at all its places in all pieces at
once; a piece without a pair left is done, and its symbols are counted. Ranks grow with the tokens they make,
so merging all places of the lowest rank is what merging them one by one comes to.

A round costs a pass over the array, and a piece takes a round for each rank that it uses, so pieces beyond LONG bytes are merged by
themselves: the places of each rank are kept in a list, the lowest rank's places are applied together, and only their neighbours are looked up again.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ambermill.llm.common import chunks, column
from ambermill.llm.presplit import PieceCache, all_pieces
from ambermill.llm.vocabulary import DEFAULT, Vocabulary, load

NONE = np.iinfo(np.int32).max
LONG = 512


class RankMerger:
    def __init__(self, vocab: Vocabulary) -> None:
        m = np.array(vocab.merges, dtype=np.int64)
        self.base = vocab.size
        keys = m[:, 0] * self.base + m[:, 1]
        order = np.argsort(keys)
        self.keys, self.ranks, self.made = keys[order], order.astype(np.int32), m[:, 2].astype(np.int32)
        self.merge = {(u, v): (k, w) for k, (u, v, w) in enumerate(vocab.merges)}
        self.byte_id = np.array(vocab.byte_id, dtype=np.int32)
        self.specials = vocab.specials

    def pair_ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left.astype(np.int64) * self.base + right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.ranks[at], NONE)

    def counts(self, words: Sequence[bytes]) -> np.ndarray:
        """Symbols that survive in each word."""
        sizes = np.array([len(w) for w in words], dtype=np.int64)
        out = sizes.copy()
        sym = self.byte_id[np.frombuffer(b"".join(words), dtype=np.uint8)]
        own = np.repeat(np.arange(len(words)), sizes)
        while len(sym) > 1:
            rank = self.pair_ranks(sym[:-1], sym[1:])
            rank[own[:-1] != own[1:]] = NONE
            first = np.flatnonzero(np.r_[True, own[1:] != own[:-1]])
            low = np.minimum.reduceat(np.r_[rank, NONE].astype(np.int32), first)
            spread = np.repeat(low, np.diff(np.r_[first, len(sym)]))
            hit = (rank == spread[:-1]) & (rank != NONE)
            places = np.flatnonzero(hit)
            # in a run of equal symbols every second pair merges, from the left
            run = np.flatnonzero(np.r_[True, np.diff(places) != 1]) if len(places) else places
            if len(run) < len(places):
                offset = np.arange(len(places)) - np.repeat(run, np.diff(np.r_[run, len(places)]))
                places = places[offset % 2 == 0]
            if len(places):
                sym[places] = self.made[rank[places]]
                np.subtract.at(out, own[places], 1)
            live = spread != NONE
            live[places + 1] = False
            sym, own = sym[live], own[live]
        return out

    def count_long(self, word: bytes) -> int:
        """Symbols that survive in a long word."""
        merge, sym = self.merge, self.byte_id[np.frombuffer(word, dtype=np.uint8)].tolist()
        n = len(sym)
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))
        places: dict[int, list[int]] = {}
        for i in range(n - 1):
            if found := merge.get((sym[i], sym[i + 1])):
                places.setdefault(found[0], []).append(i)
        ranks = list(places)
        heapq.heapify(ranks)
        left = n
        while ranks:
            rank = heapq.heappop(ranks)
            for i in sorted(places.pop(rank)):
                j = after[i]
                # a place counts only if it still holds this pair; a merged symbol is marked by -1
                if sym[i] < 0 or j >= n or (found := merge.get((sym[i], sym[j]))) is None or found[0] != rank:
                    continue
                sym[i], sym[j], left = found[1], -1, left - 1
                k = after[i] = after[j]
                if k < n:
                    before[k] = i
                for a, b in ((before[i], i), (i, k)):
                    if a >= 0 and b < n and (found := merge.get((sym[a], sym[b]))):
                        if found[0] not in places:
                            places[found[0]] = []
                            heapq.heappush(ranks, found[0])
                        places[found[0]].append(a)
        return left

    def count_pieces(self, pieces: Sequence[str]) -> list[int]:
        words = [b"" if p in self.specials else p.encode() for p in pieces]
        got = self.counts([w if len(w) <= LONG else b"" for w in words]).tolist()
        return [1 if p in self.specials else self.count_long(w) if len(w) > LONG else n for p, w, n in zip(pieces, words, got, strict=True)]


@lru_cache(maxsize=2)
def merger(name_or_path: str = DEFAULT) -> RankMerger:
    return RankMerger(load(name_or_path))


@lru_cache(maxsize=2)
def _cache(name_or_path: str) -> PieceCache:
    return PieceCache(merger(name_or_path).count_pieces)


def count_tokens(docs: DataFrame, text: str = "text", keep: Sequence[str] = ("doc_id",), tokenizer: str = DEFAULT) -> DataFrame:
    """keep columns, n_bytes (UTF-8) and n_tokens of each whole text.

    NULL and empty texts count 0 and 0; a special token in a text counts 1. Rows are independent: repeated rows stay, an
    empty table gives an empty one, further columns play no part.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = _cache(tokenizer)
        for part, texts in chunks(batches, "_text"):
            split = [all_pieces(t) for t in texts]
            known = cache.fill(p for words in split for p in words)
            n = [sum([known[w] for w in words]) for words in split]
            size = pc.fill_null(pc.binary_length(column(part, "_text")), 0).cast(pa.int64())
            yield pa.RecordBatch.from_arrays([*[column(part, k) for k in keep], size, pa.array(n, pa.int64())], names=[*keep, "n_bytes", "n_tokens"])

    fields = [docs.schema[k] for k in keep] + [T.StructField("n_bytes", T.LongType()), T.StructField("n_tokens", T.LongType())]
    return docs.select(*keep, F.col(text).alias("_text")).mapInArrow(run, T.StructType(fields))
