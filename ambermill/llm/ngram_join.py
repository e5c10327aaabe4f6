"""Exact set-similarity join on word n-grams, filtered under several global token orders.

A document's tokens are the 64-bit hashes of its distinct n-grams. Let A be the smaller set of a linked pair (or equal in size), with n tokens: A
lacks at most p = n - ceil(2 t n / (1 + t)) tokens of the other, at a Jaccard similarity of t. So of ANY part of A's tokens all but p are in the other,
and under any order the first p + 1 of that part hold a token of the other. Orders used, each prefix being a condition that every linked pair meets:

  1. by hash: A's own part are its tokens below a hash bound that falls with n; a document shows its tokens below the bound of the
     smallest set that it can be linked with, so what A's part shares with the other is shown by it. A document of whose own part more than p
     tokens occur nowhere else can't be the smaller of a pair: this is a count, no pairs are made, so a passage that thousands of
     documents share costs one row for each of them and nothing more;
  2. by rarity: the p + 1 rarest tokens of the own part name the lists in which a document looks for partners (those that occur
     nowhere else come first, and name none), so tokens of common passages come up only in documents that consist of them;
  3. and 4. by two further hashes: pairs found must share a token of their prefixes (of n - ceil(t n) + 1) under both orders.

Pairs that pass all filters are verified on their whole token sets. Documents with equal sets are one class from the start. In ROUNDS rounds, each
list gets HEADS heads, and each class is compared with the heads of its lists, where sizes and parity sketches allow it; so large groups
of copies become components in steps that grow with their size. Lists that then still hold several components pair their classes
across components, each pair in the first list that it shares, where sizes and sketches allow it.
"""

from __future__ import annotations

import functools
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ambermill.llm.common import chunks, column, components, open_lists, small, stash, unstash
from ambermill.llm.hashing import WORDS, shingle_hashes, splitmix, text_batches, word_hashes

FULL = float(1 << 64)
SLACK, MARGIN = 1.2, 12.0
SKETCH, WIDE, LARGE = 16, 256, 800  # longs, longs, tokens
ROUNDS, HEADS = 2, 8
EARLIER = 64  # keys
ORDERS = (np.uint64(0x2545F4914F6CDD1D), np.uint64(0xD6E8FEB86659FD93))


def lacking(n, percent: int):
    """Most tokens that a linked document may lack: n - ceil(percent * n / 100)."""
    return n - (n * percent + 99) // 100


def bound(n: np.ndarray, percent: int) -> np.ndarray:
    """Share of the hash space that holds the own part of a set of n tokens: somewhat more than it may lack. Falls as n grows."""
    return np.minimum(1.0, SLACK * (100 - percent) / (100 + percent) + MARGIN / np.maximum(n, 1))


def below(tokens: np.ndarray, share: float) -> int:
    """How many of the ascending tokens lie below a share of the hash space."""
    return len(tokens) if share >= 1 else int(np.searchsorted(tokens, np.uint64(int(share * FULL))))


def token_sets(texts: list[str], width: int) -> list[np.ndarray]:
    """Distinct n-gram hashes of each text, ascending."""
    data, starts = text_batches(texts, lower=True)
    words, at = word_hashes(data, WORDS)
    cut = np.searchsorted(at, starts)
    return [np.unique(shingle_hashes(words[a:b], width)) for a, b in zip(cut[:-1], cut[1:], strict=True)]


def set_hash(tokens: np.ndarray) -> int:
    """Hash of a whole set, as a signed 64-bit integer."""
    if not len(tokens):
        return 0
    mixed = splitmix(tokens)
    both = np.array([np.bitwise_xor.reduce(mixed), np.add.reduce(tokens)], np.uint64)
    return int(splitmix(both[:1] + both[1:] * np.uint64(3)).view(np.int64)[0])


def order_prefix(tokens: np.ndarray, order: np.uint64, percent: int) -> np.ndarray:
    """First n - ceil(t n) + 1 tokens under an order, shortened to 32 bits (a shared token stays shared)."""
    keys = splitmix(tokens ^ order)
    k = lacking(len(tokens), percent) + 1
    first = np.sort(np.argpartition(keys, k - 1)[:k]) if k < len(keys) else np.arange(len(keys))
    return (tokens[first] >> np.uint64(32)).astype(np.uint32).view(np.int32)


def parity_sketch(tokens: np.ndarray, longs: int = SKETCH) -> np.ndarray:
    """The parity of the tokens that fall on each of 64 * longs bits."""
    at = (splitmix(tokens) % np.uint64(64 * longs)).astype(np.int64)
    odd = (np.bincount(at, minlength=64 * longs) & 1).astype(np.uint8)
    return np.packbits(odd).view(np.int64)


def _longs(arrays: list[np.ndarray], kind=pa.int64()) -> pa.Array:
    ends = np.cumsum([0] + [len(a) for a in arrays], dtype=np.int32)
    flat = np.concatenate(arrays) if arrays else np.empty(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat, kind))


def row_key(doc_id: str, text: str) -> Column:
    """Names a row, also one without an id: rows of equal keys have the same id and text."""
    return F.xxhash64(doc_id, text)


def shown_tokens(docs: DataFrame, width: int, percent: int) -> DataFrame:
    """row (a number of its own), doc_id, k (row_key), n (set size), h (hash of the set), own, shown: the tokens shown, of which the first `own` are the own part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = TaskContext.get().partitionId() << 33
        for part, texts in chunks(batches, "_text", 1 << 19):
            sets = token_sets(texts, width)
            n = np.array([len(s) for s in sets], np.int64)
            wide, narrow = bound(-(-n * percent // 100), percent), bound(n, percent)
            shown = [s[: below(s, b)].view(np.int64) for s, b in zip(sets, wide, strict=True)]
            own = [below(s, b) for s, b in zip(sets, narrow, strict=True)]
            cols = [pa.array(np.arange(at, at + len(n))), column(part, "doc_id"), column(part, "k"), pa.array(n), pa.array([set_hash(s) for s in sets], pa.int64()), pa.array(own, pa.int32()), _longs(shown)]
            at += len(n)
            yield pa.RecordBatch.from_arrays(cols, names=["row", "doc_id", "k", "n", "h", "own", "shown"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.withColumn("k", row_key("doc_id", "_text")).select("doc_id", "k", "_text").mapInArrow(run, f"row long, doc_id {kind}, k long, n long, h long, own int, shown array<long>")


def of_sets(docs: DataFrame, width: int, schema: str, columns: Callable[[list[np.ndarray]], list[pa.Array]]) -> DataFrame:
    """h and what `columns` makes of the token sets of documents given as _text; a row each."""
    names = ["h", *[c.split()[0] for c in schema.split(", ")]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, texts in chunks(batches, "_text", 1 << 19):
            sets = [s for s in token_sets(texts, width) if len(s)]
            yield pa.RecordBatch.from_arrays([pa.array([set_hash(s) for s in sets], pa.int64()), *columns(sets)], names=names)

    return docs.select("_text").mapInArrow(run, f"h long, {schema}")


def once(sets: DataFrame, name: str) -> DataFrame:
    """Stored, one row a class. Only rows that repeat an id and text give a class twice, so that is looked for before anything is shuffled."""
    out = stash(sets, name)
    if out.count() == out.select("h").distinct().count():
        return out
    single = stash(out.dropDuplicates(["h"]), name)
    unstash(out)
    return single


def outlines(docs: DataFrame, width: int) -> DataFrame:
    """h, sketch."""
    return of_sets(docs, width, "sketch array<long>", lambda sets: [_longs([parity_sketch(s) for s in sets])])


def whole_sets(docs: DataFrame, width: int, percent: int) -> DataFrame:
    """h, n, wide (a larger sketch of sets beyond LARGE, whose first one is full; else empty), o3, o4 (prefixes under two orders), tokens (ascending, 8 bytes each)."""

    def columns(sets: list[np.ndarray]) -> list[pa.Array]:
        wide = [parity_sketch(s, WIDE) if len(s) > LARGE else np.empty(0, np.int64) for s in sets]
        orders = [_longs([order_prefix(s, o, percent) for s in sets], pa.int32()) for o in ORDERS]
        return [pa.array([len(s) for s in sets], pa.int64()), _longs(wide), *orders, pa.array([s.tobytes() for s in sets], pa.binary())]

    return of_sets(docs, width, "n long, wide array<long>, o3 array<int>, o4 array<int>, tokens binary", columns)


def sizes_fit(a: Column, b: Column, percent: int) -> Column:
    return F.least(a, b) * 100 >= F.greatest(a, b) * percent


def shares_enough(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    both = np.sort(np.concatenate([x, y]), kind="stable")
    shared = int((both[1:] == both[:-1]).sum())
    return 100 * shared >= percent * (len(x) + len(y) - shared)


def may_link(percent: int) -> Column:
    """Whether sides a and b may be linked, by sizes and sketches; only pairs that can't be are refused. Each bit in which sketches differ
    stands for a token that only one side has, and linked sets have at most (1 - t) / (1 + t) of both sizes together of those."""
    apart = sum((F.bit_count(F.col("sketch_a")[k].bitwiseXOR(F.col("sketch_b")[k])) for k in range(SKETCH)), F.lit(0))
    return sizes_fit(F.col("n_a"), F.col("n_b"), percent) & (apart * (100 + percent) <= (F.col("n_a") + F.col("n_b")) * (100 - percent))


def may_link_wide(percent: int) -> Column:
    """The same by the larger sketches, where both sides have them."""
    apart = F.aggregate(F.zip_with("wide_a", "wide_b", lambda x, y: F.coalesce(F.bit_count(x.bitwiseXOR(y)), F.lit(0))), F.lit(0), lambda a, b: a + b)
    return apart * (100 + percent) <= (F.col("n_a") + F.col("n_b")) * (100 - percent)


def named(table: DataFrame, x: str) -> DataFrame:
    """A table of classes as one side of pairs: h is x, the other columns end in _x."""
    return table.select(F.col("h").alias(x), *[F.col(c).alias(f"{c}_{x}") for c in table.columns if c != "h"])


class Verifier:
    """Exact verification. Only the documents of classes that are in a pair are read and hashed again, one of each class."""

    def __init__(self, texts: DataFrame, reps: DataFrame, width: int, percent: int) -> None:
        self.texts, self.reps, self.width, self.percent = texts, reps, width, percent

    def linked(self, pairs: DataFrame) -> DataFrame:
        """The stored pairs (a, b) that share tokens of their prefixes under both further orders, and have 100 * intersection >= percent * union.
        b's set doesn't travel with the pairs, so the head of many pairs should be b."""
        percent = self.percent
        ids = stash(pairs.select(F.explode(F.array("a", "b")).alias("h")).distinct(), "ids")
        keys = stash(self.reps.join(small(ids, 8), "h", "left_semi").select("k"), "keys")
        sets = once(whole_sets(self.texts.join(small(keys, 8), "k", "left_semi"), self.width, percent), "sets")
        wide = sets.where(F.size("wide") > 0).select("h", "n", "wide")
        left = pairs.join(named(wide, "a"), "a", "left").join(named(wide, "b"), "b", "left")
        left = stash(left.where(F.col("wide_a").isNull() | F.col("wide_b").isNull() | may_link_wide(percent)).select("a", "b"), "left")
        orders = sets.select("h", "o3", "o4")
        near = left.join(named(orders, "a"), "a").join(named(orders, "b"), "b")
        near = stash(near.where(F.arrays_overlap("o3_a", "o3_b") & F.arrays_overlap("o4_a", "o4_b")).select("a", "b"), "near")

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                both = zip(column(b, "tokens_a"), column(b, "tokens_b"), strict=True)
                keep = [shares_enough(np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64), percent) for x, y in both]
                yield b.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

        met = stash(near.select(F.explode(F.array("a", "b")).alias("h")).distinct(), "met")
        tokens = sets.select("h", "tokens").join(small(met, 8), "h", "left_semi")
        both = near.join(named(tokens, "a"), "a").join(named(tokens, "b"), "b").select("a", "b", "tokens_a", "tokens_b")
        out = stash(both.mapInArrow(run, "a long, b long"), "proven")
        unstash(ids, keys, sets, left, near, met)
        return out


def token_lists(shown: DataFrame, percent: int) -> DataFrame:
    """key (a token), id (a class), n (its size), holder: the lists of tokens that a class holds among its rarest, with all classes that show the token."""
    p = F.col("n") - F.ceil(2 * percent * F.col("n") / (100 + percent))
    first = stash(shown.where("n > 0").groupBy("h").agg(F.min("row").alias("row")).select("row"), "first")
    classes = shown.join(small(first, 8), "row", "left_semi")
    tokens = classes.select("h", "n", F.posexplode("shown").alias("at", "t"), "own").select("h", "n", "t", (F.col("at") < F.col("own")).alias("inside"))
    # order 1: tokens of more than one class
    common = stash(tokens.groupBy("t").agg(F.count(F.lit(1)).alias("df")).where("df > 1"), "common")
    shared = stash(tokens.join(small(common, 16), "t"), "shared")
    sizes = classes.select("h", "n", "own")
    inner = shared.where("inside").groupBy("h").agg(F.count(F.lit(1)).alias("inner"))
    alive = stash(inner.join(sizes, "h").withColumn("p", p).where("inner >= own - p").select("h", (F.col("p") + 1 + F.col("inner") - F.col("own")).alias("held")), "alive")
    # order 2: the p + 1 rarest tokens, less those that no other class has
    rank = F.row_number().over(Window.partitionBy("h").orderBy("df", "t"))
    held = shared.where("inside").join(small(alive, 16), "h").withColumn("rank", rank).where("rank <= held").select("h", "t")
    held = stash(held, "held")
    looked = stash(held.select("t").distinct(), "looked")
    members = shared.join(small(looked, 8), "t").join(held.withColumn("holder", F.lit(True)), ["h", "t"], "left")
    lists = stash(members.select(F.col("t").alias("key"), F.col("h").alias("id"), "n", F.coalesce("holder", F.lit(False)).alias("holder")), "lists")
    unstash(first, common, shared, alive, held, looked)
    return lists


def met_heads(lists: DataFrame, outline: DataFrame, percent: int, turn: int) -> DataFrame:
    """(a, b): each class with the heads of its lists that are of other components and that it may be linked with; stored. A list has
    HEADS heads, drawn by hash anew each turn, classes of grown components first; lists of much the same classes draw much the same heads, so pairs stay few."""
    rank = F.row_number().over(Window.partitionBy("key").orderBy(F.col("grown").desc(), F.xxhash64("id", F.lit(turn)), "id"))
    heads = lists.withColumn("rank", rank).where(F.col("rank") <= HEADS).select("key", F.col("id").alias("b"), F.col("n").alias("n_b"), F.col("root").alias("root_b"))
    heads = stash(heads, "heads")
    met = lists.withColumnsRenamed({"id": "a", "n": "n_a"}).join(small(heads, 32), "key").where((F.col("root") != F.col("root_b")) & sizes_fit(F.col("n_a"), F.col("n_b"), percent))
    met = met.select("a", "n_a", "b", "n_b").distinct()
    out = stash(met.join(named(outline, "a"), "a").join(named(outline, "b"), "b").where(may_link(percent)).select("a", "b"), "tried")
    unstash(heads)
    return out


def cross_pairs(lists: DataFrame, outline: DataFrame, percent: int) -> tuple[DataFrame, list[DataFrame]]:
    """(a, b), and the stored tables it reads: the classes of open lists that are of different components and may be linked, where the smaller holds a list that the other is in.

    Of equal sizes either could be the smaller, so the lesser id is. A row is made in the first such list alone: `earlier` are the lists before, at
    most EARLIER of them, so that rows stay small; a pair that only meets beyond those comes up again, and is one by distinct().
    """
    own = lists.groupBy("id").agg(F.array_sort(F.collect_list("key")).alias("keys"), F.array_sort(F.collect_list(F.when(F.col("holder"), F.col("key")))).alias("held"))
    own = stash(own.select(F.col("id").alias("h"), *[F.slice(c, 1, EARLIER).alias(c) for c in ("keys", "held")]), "own")
    sides = stash(lists.drop("grown").withColumnRenamed("id", "h").join(outline.join(own, "h"), "h"), "sides")
    before = lambda c: F.filter(c, lambda k: k < F.col("key")).alias("earlier")
    left = named(sides.where("holder").select("h", "key", "n", "root", "sketch", before("held")), "a")
    right = named(sides.select("h", "key", "n", "root", "sketch", before("keys")), "b")
    smaller = (F.col("n_a") < F.col("n_b")) | ((F.col("n_a") == F.col("n_b")) & (F.col("a") < F.col("b")))
    fits = (F.col("key_a") == F.col("key_b")) & (F.col("root_a") != F.col("root_b")) & smaller & may_link(percent) & ~F.arrays_overlap("earlier_a", "earlier_b")
    return left.join(right, fits).select("a", "b"), [own, sides]


def class_links(lists: DataFrame, outline: DataFrame, verifier: Verifier) -> DataFrame | None:
    """(node, root) of classes that are linked, as components() gives them. A pair counts if it shares a list that its smaller class holds."""
    percent, proven, tried, roots = verifier.percent, [], [], None
    union = lambda tables: functools.reduce(DataFrame.unionByName, tables)
    open_ = open_lists(lists, roots)
    for turn in range(ROUNDS):
        tried.append(met_heads(open_, outline, percent, turn))
        proven.append(verifier.linked(tried[-1]))
        if proven[-1].isEmpty():
            break
        roots = components(union(proven))
        unstash(open_)
        open_ = open_lists(lists, roots)
    met, stored = cross_pairs(open_, outline, percent)
    ordered = F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")
    pairs = stash(met.select(*ordered).distinct().join(union(tried).select(*ordered), ["a", "b"], "left_anti"), "pairs")
    if not pairs.isEmpty():
        roots = components(union([*proven, verifier.linked(pairs)]))
    unstash(open_, *stored, pairs, *tried, *proven)
    return roots


def similar_documents(docs: DataFrame, width: int = 5, percent: int = 80, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """doc_id, k (row_key), n_shingles, h (the class of equal sets), root (of the component, NULL without words) and component_id: the
    least doc_id reachable over links. Components of repeated ids can share a component_id, and those without ids have none; root tells them apart.

    Words are runs of bytes other than space and tab to carriage return, A-Z lower-cased; a text of fewer than width words is one
    n-gram. Two documents link if 100 * |intersection| >= percent * |union|. Documents without words are linked with nothing (component_id is their own id), and
    NULL texts are without words. Rows that repeat an id and text are copies. A NULL id is never a component's name unless all its
    documents lack one. An empty table gives an empty one; further columns play no part. Sets are compared by 64-bit hashes.
    """
    own = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("_text"))
    shown = stash(shown_tokens(own, width, percent), "shown")
    lists = token_lists(shown, percent)
    wanted = stash(lists.select(F.col("id").alias("h")).distinct(), "wanted")
    reps = stash(shown.select("h", "k").join(small(wanted, 8), "h", "left_semi").groupBy("h").agg(F.min("k").alias("k")), "reps")
    texts = own.withColumn("k", row_key("doc_id", "_text"))
    outline = once(outlines(texts.join(small(reps.select("k"), 8), "k", "left_semi"), width), "outline")
    roots = class_links(lists, outline, Verifier(texts, reps, width, percent))
    rows = shown.select("doc_id", "k", "n", "h")
    rows = rows.withColumn("root", F.lit(None).cast("long")) if roots is None else rows.join(small(roots, 16).withColumnRenamed("node", "h"), "h", "left")
    rows = stash(rows.withColumn("root", F.when(F.col("n") > 0, F.coalesce("root", "h"))), "rows")
    unstash(shown, lists, wanted, reps, outline)
    least = stash(rows.where("n > 0").groupBy("root").agg(F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("rows")).where("rows > 1").drop("rows"), "least")
    out = rows.join(small(least, 24), "root", "left")
    return out.select("doc_id", "k", F.col("n").alias("n_shingles"), "h", "root", F.coalesce("least", "doc_id").alias("component_id"))
