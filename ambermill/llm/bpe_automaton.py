"""BPE encoding and decoding by an automaton over tokens.

The merges are compiled by successive merge gadgets. The start automaton has one state and a loop for each byte. The
gadget of a merge (l, r) -> w looks at the state that l leads to: it gets a copy without the arc r, to which the arcs l are
redirected, and every state with an arc l gets an arc w that leads where l, r led. All arcs of one token keep leading to
one state, so a state is named by the token just read, the automaton stays deterministic, and what a gadget does to
one pair of tokens depends on earlier gadgets for that pair alone:

  * arcs between bytes exist from the start; the gadget of (u, v) itself removes the arc v from state u;
  * a new token w = (l, r) takes over the arcs that state r had before its gadget,
  * and is put beside the arc l in every state that has it after its gadget.

So the table is compiled arc by arc when it is first asked for, with 50,000 gadgets replayed for that pair only, and kept
in a bounded store; written out in full it would have the square of the vocabulary's size.

A word's tokens are the one path of the automaton that spells it. Reading its bytes from the left, each position
has exactly one token that ends there and continues the path of the position where it starts; the last of
them, followed back, give the ids. Decoding emits the label of each arc.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ambermill.llm.common import chunks, column
from ambermill.llm.presplit import PieceCache, all_pieces
from ambermill.llm.vocabulary import DEFAULT, Vocabulary, load

NEVER = 1 << 60


class MergeAutomaton:
    ARC_LIMIT = 400_000

    def __init__(self, vocab: Vocabulary) -> None:
        self.labels, self.specials = vocab.labels, vocab.specials
        n = vocab.size
        self.left, self.right, self.born = [-1] * n, [-1] * n, [-1] * n
        self.rank: dict[tuple[int, int], int] = {}
        for k, (u, v, w) in enumerate(vocab.merges):
            self.left[w], self.right[w], self.born[w] = u, v, k
            self.rank[u, v] = k
        special = set(vocab.specials.values())
        made: set[int] = set()  # tokens whose own gadget found its arc
        for t in sorted((i for i in range(n) if vocab.labels[i] and i not in special), key=self.born.__getitem__):
            if self.born[t] < 0 or (self.left[t] in made and self.right[t] in made and self._replay(self.left[t], self.right[t], self.born[t])):
                made.add(t)
        self.token = {vocab.labels[t]: t for t in made}
        tails: dict[bytes, set[int]] = {}
        for label in self.token:
            tails.setdefault(label[-2:], set()).add(len(label))
        self.lengths = {b: sorted(s, reverse=True) for b, s in tails.items()}
        self.longest = max(map(len, self.token))
        self.n = n
        self.arcs: dict[int, bool] = {}

    def arc(self, u: int, v: int) -> bool:
        """Whether state u has the arc v after all gadgets."""
        key = u * self.n + v
        known = self.arcs.get(key)
        if known is None:
            if len(self.arcs) >= self.ARC_LIMIT:
                self.arcs.clear()
            known = self.arcs[key] = self._replay(u, v)
        return known

    def _replay(self, u: int, v: int, until: int = NEVER) -> bool:
        """Whether state u has the arc v just before the gadget `until`."""
        left, right, born, rank = self.left, self.right, self.born, self.rank
        while True:
            if rank.get((u, v), NEVER) < until:
                return False
            bu, bv = born[u], born[v]
            if bu < 0 and bv < 0:
                return True
            if bu > bv:
                u, until = right[u], bu
            else:
                v, until = left[v], bv + 1

    def encode_word(self, word: bytes) -> list[int]:
        """Ids of one pre-split word."""
        token, lengths, n, known, arc = self.token, self.lengths, self.n, self.arcs.get, self.arc
        whole = token.get(word)
        if whole is not None:
            return [whole]
        size, longest = len(word), self.longest
        state, start = [0] * (size + 1), [0] * (size + 1)
        for i in range(1, size + 1):
            t = token.get(word[:i]) if i <= longest else None
            if t is not None:
                state[i] = t
                continue
            for k in (*lengths.get(word[i - 2 : i], ()), 1):
                j = i - k
                if j > 0:
                    t = token.get(word[j:i])
                    if t is not None:
                        u = state[j]
                        ok = known(u * n + t)
                        if ok is None:
                            ok = arc(u, t)
                        if ok:
                            state[i], start[i] = t, j
                            break
        out = []
        i = size
        while i:
            out.append(state[i])
            i = start[i]
        out.reverse()
        return out

    def encode_pieces(self, words: Iterable[str]) -> list[bytes]:
        """Ids of pieces as packed 32-bit integers."""
        specials = self.specials
        return [np.array([specials[w]] if w in specials else self.encode_word(w.encode()), dtype=np.int32).tobytes() for w in words]

    def decode(self, ids: Sequence[int]) -> str:
        labels = self.labels
        return b"".join([labels[i] for i in ids]).decode("utf-8", "replace")


@lru_cache(maxsize=2)
def automaton(name_or_path: str = DEFAULT) -> MergeAutomaton:
    return MergeAutomaton(load(name_or_path))


@lru_cache(maxsize=2)
def _cache(name_or_path: str) -> PieceCache:
    return PieceCache(automaton(name_or_path).encode_pieces)


def _token_batches(batches: Iterator[pa.RecordBatch], text: str, keep: Sequence[str], tokenizer: str, decoded: bool) -> Iterator[pa.RecordBatch]:
    machine, cache = automaton(tokenizer), _cache(tokenizer)
    for part, texts in chunks(batches, text):
        split = [all_pieces(t) for t in texts]
        known = cache.fill(p for words in split for p in words)
        packed = [b"".join([known[w] for w in words]) for words in split]
        ends = np.cumsum([0] + [len(p) // 4 for p in packed], dtype=np.int64)
        flat = np.frombuffer(b"".join(packed), dtype=np.int32)
        cols = [column(part, k) for k in keep]
        cols.append(pa.LargeListArray.from_arrays(pa.array(ends), pa.array(flat)).cast(pa.list_(pa.int32())))
        names = [*keep, "ids"]
        if decoded:
            cols.append(pa.array([machine.decode(flat[a:b].tolist()) for a, b in zip(ends[:-1], ends[1:], strict=True)], pa.string()))
            names.append("decoded")
        yield pa.RecordBatch.from_arrays(cols, names=names)


def encode_documents(docs: DataFrame, text: str = "text", keep: Sequence[str] = ("doc_id",), tokenizer: str = DEFAULT, decoded: bool = False) -> DataFrame:
    """keep columns, ids array<int> and, if asked for, decoded: the text that the ids spell.

    NULL and empty texts have no ids. Special tokens in a text are taken as such. Rows are independent: repeated rows stay,
    ties don't arise, an empty table gives an empty one, further columns of docs play no part. Texts of any
    length are split in parts, so memory follows the longest text, not the batch.
    """
    fields = [docs.schema[k] for k in keep] + [T.StructField("ids", T.ArrayType(T.IntegerType(), True))]
    if decoded:
        fields.append(T.StructField("decoded", T.StringType()))
    own = docs.select(*keep, F.col(text).alias("_text"))
    return own.mapInArrow(lambda it: _token_batches(it, "_text", list(keep), tokenizer, decoded), T.StructType(fields))


def decode_ids(df: DataFrame, ids: str = "ids", keep: Sequence[str] = ("doc_id",), tokenizer: str = DEFAULT) -> DataFrame:
    """keep columns and decoded: the text that an array of ids spells. NULL gives an empty text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = automaton(tokenizer)
        for b in batches:
            texts = [machine.decode(x or ()) for x in column(b, "_ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([*[column(b, k) for k in keep], pa.array(texts, pa.string())], names=[*keep, "decoded"])

    fields = [df.schema[k] for k in keep] + [T.StructField("decoded", T.StringType())]
    return df.select(*keep, F.col(ids).alias("_ids")).mapInArrow(run, T.StructType(fields))
