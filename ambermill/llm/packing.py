"""Packing documents into sequences of a fixed length: first-fit decreasing over a tournament tree."""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ambermill.llm.common import chunks, column
from ambermill.llm.presplit import PieceCache, all_pieces
from ambermill.llm.vocabulary import DEFAULT, byte_letters, tokenizer_path

LENGTH = 1024
GROUP_DOCUMENTS = 4096


class TournamentTree:
    """Room left in bins, the winner of each pair above them; the first bin with room for an item is found on the way down."""

    def __init__(self, bins: int, capacity: int) -> None:
        self.leaves = 1
        while self.leaves < max(1, bins):
            self.leaves *= 2
        self.best = [capacity] * (2 * self.leaves)

    def place(self, size: int) -> tuple[int, int]:
        """(bin, room it had) of the first bin that takes the item."""
        best, at = self.best, 1
        while at < self.leaves:
            at *= 2
            if best[at] < size:
                at += 1
        room = best[at]
        slot = at - self.leaves
        best[at] = room - size
        at //= 2
        while at:
            won = max(best[2 * at], best[2 * at + 1])
            if best[at] == won:
                break
            best[at] = won
            at //= 2
        return slot, room


def first_fit_decreasing(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """(bin, offset in it) of each item; ties go by position. No item may exceed the capacity."""
    order = np.argsort(-sizes, kind="stable")
    tree = TournamentTree(len(sizes), capacity)
    bins, offsets = np.empty(len(sizes), np.int64), np.empty(len(sizes), np.int64)
    for i, size in zip(order.tolist(), sizes[order].tolist(), strict=True):
        bins[i], room = tree.place(size)
        offsets[i] = capacity - room
    return bins, offsets


@lru_cache(maxsize=2)
def _cache(name_or_path: str) -> PieceCache:
    """Ids of pieces, by the library's model alone: the pieces are split already, so its encodings, with their offsets and masks, would be made for nothing."""
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(tokenizer_path(name_or_path))
    model, letters = t.model, str.maketrans({chr(b): c for c, b in byte_letters().items()})
    special = {token.content: i for i, token in t.get_added_tokens_decoder().items()}

    def ids(piece: str) -> bytes:
        found = [special[piece]] if piece in special else [x.id for x in model.tokenize(piece.encode().decode("latin-1").translate(letters))]
        return struct.pack(f"<{len(found)}I", *found)

    return PieceCache(lambda pieces: [ids(p) for p in pieces])


PIECE = T.StructType(
    [
        T.StructField("start", T.LongType()),
        T.StructField("length", T.LongType()),
        T.StructField("ids_crc32", T.LongType()),
        T.StructField("doc_tokens", T.LongType()),
    ]
)


def document_pieces(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", tokenizer: str = DEFAULT, length: int = LENGTH, end_id: int = 0) -> DataFrame:
    """Tokens of each document, closed by end_id and cut every `length`: doc_id, start, length, ids_crc32, doc_tokens."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache, end, step = _cache(tokenizer), np.array([end_id], "<u4").tobytes(), 4 * length
        for part, texts in chunks(batches, "_text"):
            split = [all_pieces(t) for t in texts]
            known = cache.fill(set().union(*split))
            row, start, size, crc, total = [], [], [], [], []
            for i, words in enumerate(split):
                ids = b"".join([known[w] for w in words]) + end
                for at in range(0, len(ids), step):
                    piece = ids[at : at + step]
                    row.append(i)
                    start.append(at // 4)
                    size.append(len(piece) // 4)
                    crc.append(zlib.crc32(piece))
                    total.append(len(ids) // 4)
            cols = [column(part, "doc_id").take(pa.array(row, pa.int64())), *[pa.array(x, pa.int64()) for x in (start, size, crc, total)]]
            yield pa.RecordBatch.from_arrays(cols, names=["doc_id", *PIECE.names])

    schema = T.StructType([T.StructField("doc_id", docs.schema[doc_id].dataType), *PIECE.fields])
    return docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("_text")).mapInArrow(run, schema)


def pack_documents(
    docs: DataFrame, text: str = "text", doc_id: str = "doc_id", tokenizer: str = DEFAULT, length: int = LENGTH, group_documents: int = GROUP_DOCUMENTS, end_id: int = 0
) -> DataFrame:
    """Pack documents into sequences of at most `length` tokens: one row a piece, with sequence_id and offset.

    A document longer than `length` is cut; its full pieces make sequences of their own, the rest is packed. Documents are
    dealt into randomised groups of about group_documents, and each group is packed alone, so a group's work and
    memory don't grow with the corpus, and a lost task packs its group again to the same result. sequence_id is the group's
    number times 2**32 plus the sequence's number in it. A NULL or empty text is the single token end_id. Repeated rows are packed
    each; ties in size go by doc_id and start. An empty table gives an empty one; further columns play no part.
    """
    pieces = document_pieces(docs, text, doc_id, tokenizer, length, end_id)
    groups = max(1, -(-docs.count() // group_documents))
    dealt = pieces.withColumn("_g", F.pmod(F.xxhash64("doc_id", "doc_tokens"), F.lit(groups)))

    names = [*pieces.columns, "sequence_id", "offset"]

    def pack(df: pd.DataFrame) -> pd.DataFrame:
        df = df.sort_values(["doc_id", "start", "ids_crc32"], kind="stable", na_position="first")
        base = int(df["_g"].iloc[0]) << 32
        full = df[df["length"] == length].assign(offset=0)
        full["sequence_id"] = base + np.arange(len(full), dtype=np.int64)
        rest = df[df["length"] < length].copy()
        bins, rest["offset"] = first_fit_decreasing(rest["length"].to_numpy(np.int64), length)
        rest["sequence_id"] = base + len(full) + bins
        return pd.concat([full, rest])[names]

    schema = T.StructType([*pieces.schema.fields, T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])
    return dealt.groupBy("_g").applyInPandas(pack, schema)
