"""Approximate nearest neighbours by an inverted multi-index.

Vectors are cut into two halves, each quantised by its own k-means; a vector's cell is its pair of centroids. A query walks the
pairs by rising summed distance with a heap (here the distance of a half is the negative inner product with its centroid)
until the cells it has passed hold a share of the index; their entries are reranked by the exact inner product. The share is the one at which
queries among the rows that the quantisers are fitted on find the wanted recall of their nearest in those rows (which lie
farther apart than all rows do, so it errs on the side of recall). Entries lie in parts of cells; a cell larger than a part is spread over several.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ambermill.llm.common import column, stash

CENTROIDS = 128
MOST_FIT = 20_000
PART = 8_192
QUERIES = 8_192
RECALL = 0.95
TRIALS = 256


def usable(vector: Column, dim: Column | None = None) -> Column:
    """Whether a vector has no NULL, NaN or infinite component and isn't zero (or empty)."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    ok = vector.isNotNull() & ~F.coalesce(bad, F.lit(True)) & F.exists(vector, lambda x: x != 0)
    return F.coalesce(ok if dim is None else ok & (F.size(vector) == dim), F.lit(False))


def kmeans(x: np.ndarray, k: int, rounds: int = 12, seed: int = 1) -> np.ndarray:
    """Lloyd's algorithm from random rows; a centroid without rows stays where it was."""
    c = x[np.random.default_rng(seed).choice(len(x), k, replace=False)].copy()
    for _ in range(rounds):
        near = np.argmax(x @ c.T - 0.5 * (c * c).sum(1), axis=1)
        total = np.zeros_like(c)
        np.add.at(total, near, x)
        n = np.bincount(near, minlength=k)
        c[n > 0] = total[n > 0] / n[n > 0, None]
    return c


@dataclass
class MultiIndex:
    first: np.ndarray
    second: np.ndarray

    @property
    def half(self) -> int:
        return self.first.shape[1]

    @classmethod
    def fit(cls, sample: np.ndarray, centroids: int = CENTROIDS) -> MultiIndex:
        k = max(1, min(centroids, len(sample) // 40))
        half = max(1, sample.shape[1] // 2)
        return cls(kmeans(sample[:, :half], k), kmeans(sample[:, half:], k) if sample.shape[1] > half else np.zeros((1, 0)))

    def cells(self, x: np.ndarray) -> np.ndarray:
        near = lambda y, c: np.argmax(y @ c.T - 0.5 * (c * c).sum(1), axis=1)
        return near(x[:, : self.half], self.first) * len(self.second) + near(x[:, self.half :], self.second)

    def walk(self, q: np.ndarray, sizes: np.ndarray, wanted: int) -> list[int]:
        """Cells by rising summed distance until they hold `wanted` entries; empty cells are passed over."""
        da, db = -(self.first @ q[: self.half]), -(self.second @ q[self.half :])
        oa, ob = np.argsort(da, kind="stable"), np.argsort(db, kind="stable")
        sa, sb, w = da[oa].tolist(), db[ob].tolist(), len(self.second)
        heap, out, held = [(sa[0] + sb[0], 0, 0)], [], 0
        # row i is entered once row i-1 has left its first column, so each pair enters the heap once
        while heap and held < wanted:
            _, i, j = heapq.heappop(heap)
            cell = int(oa[i]) * w + int(ob[j])
            if sizes[cell]:
                out.append(cell)
                held += int(sizes[cell])
            if j == 0 and i + 1 < len(sa):
                heapq.heappush(heap, (sa[i + 1] + sb[0], i + 1, 0))
            if j + 1 < len(sb):
                heapq.heappush(heap, (sa[i] + sb[j + 1], i, j + 1))
        return out


def share_for(index: MultiIndex, sample: np.ndarray, k: int, recall: float, trials: int = TRIALS) -> float:
    """Share of an index over the sample at which walks find so much of the k nearest, over evenly chosen queries of the sample."""
    k = min(k, len(sample) - 1)
    if k < 1:
        return 1.0
    cells = index.cells(sample)
    sizes = np.bincount(cells, minlength=len(index.first) * len(index.second))
    need = []
    for at in np.array_split(np.unique(np.linspace(0, len(sample) - 1, trials).astype(np.int64)), 8):
        q = sample[at]
        scores = q @ sample.T
        scores[np.arange(len(at)), at] = -np.inf
        near = np.argpartition(-scores, k - 1, axis=1)[:, :k]
        reach = (q[:, : index.half] @ index.first.T)[:, :, None] + (q[:, index.half :] @ index.second.T)[:, None, :]
        order = np.argsort(-reach.reshape(len(at), len(sizes)), axis=1, kind="stable")
        passed = np.empty(order.shape)
        np.put_along_axis(passed, order, np.cumsum(sizes[order], axis=1), axis=1)
        need.append(np.take_along_axis(passed, cells[near], axis=1).ravel())
    return float(np.quantile(np.concatenate(need), recall, method="higher")) / len(sample)


def deal_cells(sizes: np.ndarray, part: int) -> tuple[np.ndarray, np.ndarray, int]:
    """(first part, number of parts) of each cell, and the number of parts. Small cells share a part; a large one has several."""
    first, count, at, held = np.zeros(len(sizes), np.int32), np.ones(len(sizes), np.int32), 0, 0
    for c, n in enumerate(sizes.tolist()):
        if n > part:
            at += 1 if held else 0
            first[c], count[c] = at, -(-n // part)
            at, held = at + int(count[c]), 0
        else:
            if held + n > part:
                at, held = at + 1, 0
            first[c], held = at, held + n
    return first, count, at + 1


def _matrix(batch: pa.RecordBatch, name: str) -> np.ndarray:
    col = column(batch, name)
    return np.asarray(col.flatten().to_numpy(zero_copy_only=False), np.float64).reshape(len(col), -1)


def top(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k best scores, ties to the smaller id; -inf is left out."""
    at = np.flatnonzero(scores > -np.inf)
    if len(at) > k:
        cut = np.partition(scores[at], len(at) - k)[len(at) - k]
        at = at[scores[at] >= cut]
    return at[np.lexsort((ids[at], -scores[at]))][:k]


def nearest(
    rows: DataFrame, is_query: Column, k: int = 20, vector: str = "embedding", vec_id: str = "vec_id", centroids: int = CENTROIDS, recall: float = RECALL, most_fit: int = MOST_FIT
) -> DataFrame:
    """The k nearest rows of each query by inner product: query_id, rank (from 1), vec_id, score.

    is_query marks the queries among the rows; candidates are all rows but those with the query's own id. Rows without an id, and vectors that are
    NULL, zero, of another length than most, or hold a NULL or non-finite component take no part. The quantisers are fitted on at most
    most_fit rows (those of least id hash); every row is indexed. Ties go to the smaller vec_id. An empty table gives an empty one.
    A query reranks the share of the index that the wanted recall takes (share_for), whatever the index's size, and k + 1 entries at least.
    Queries meet entries in tiles of at most a part and about QUERIES queries.
    """
    spark = rows.sparkSession
    own = rows.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(vector).alias("v"), is_query.alias("q")).where("vec_id is not null")
    fit = own.where(usable(F.col("v"))).agg(F.mode(F.size("v"), True).alias("dim"), F.count(F.lit(1)).alias("n")).first()
    out_schema = "query_id long, rank int, vec_id long, score double"
    if not fit["n"]:
        return spark.createDataFrame([], out_schema)
    own = own.where(usable(F.col("v"), F.lit(fit["dim"])))
    sample = own.orderBy(F.xxhash64("vec_id"), "vec_id", "v").limit(most_fit).select("v").toArrow().column("v").combine_chunks()
    sample = np.asarray(sample.flatten().to_numpy(zero_copy_only=False), np.float64).reshape(len(sample), -1)
    index = MultiIndex.fit(sample, centroids)
    share = share_for(index, sample, k, recall)
    del sample

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array(index.cells(_matrix(b, "v")), pa.int32())], names=[*b.schema.names, "cell"])

    kind = own.schema["v"].dataType.simpleString()
    celled = stash(own.mapInArrow(assign, f"vec_id long, v {kind}, q boolean, cell int"), "cells")
    held = celled.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).collect()  # at most centroids**2 rows
    sizes = np.zeros(len(index.first) * len(index.second), np.int64)
    for r in held:
        sizes[r["cell"]] = r["n"]
    total = int(sizes.sum())
    first, count, _ = deal_cells(sizes, PART)
    wanted = max(k + 1, int(np.ceil(share * total)))
    queries = celled.where("q").select(F.col("vec_id").alias("query_id"), "v")
    blocks = max(1, -(-queries.count() // QUERIES))

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for s in range(0, b.num_rows, 256):
                piece = b.slice(s, 256)
                at, parts, cells = [], [], []
                for i, q in enumerate(_matrix(piece, "v") if piece.num_rows else ()):
                    by: dict[int, list[int]] = {}
                    for c in index.walk(q, sizes, wanted):
                        for p in range(int(first[c]), int(first[c] + count[c])):
                            by.setdefault(p, []).append(c)
                    at += [i] * len(by)
                    parts += by
                    cells += by.values()
                take = pa.array(at, pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [column(piece, "query_id").take(take), column(piece, "v").take(take), pa.array(parts, pa.int32()), pa.array(cells, pa.list_(pa.int32()))],
                    names=["query_id", "v", "part", "cells"],
                )

    probed = queries.mapInArrow(probe, f"query_id long, v {kind}, part int, cells array<int>")
    probed = probed.withColumn("block", F.pmod(F.xxhash64("query_id"), F.lit(blocks)).cast("int"))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, cells = column(b, "vec_id").to_numpy(), column(b, "cell").to_numpy()
            part = first[cells] + (ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(33)).astype(np.int64) % count[cells]
            yield pa.RecordBatch.from_arrays([column(b, "vec_id"), column(b, "v"), column(b, "cell"), pa.array(part, pa.int32())], names=["vec_id", "v", "cell", "part"])

    placed = celled.select("vec_id", "v", "cell").mapInArrow(place, f"vec_id long, v {kind}, cell int, part int")
    placed = placed.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))

    def rerank(qs: pd.DataFrame, es: pd.DataFrame) -> pd.DataFrame:
        got: tuple[list, list, list] = ([], [], [])
        if len(qs) and len(es):
            ids = es["vec_id"].to_numpy(np.int64)
            names, at = np.unique(es["cell"].to_numpy(), return_inverse=True)
            e = np.array(es["v"].tolist(), np.float64)
            for s in range(0, len(qs), 128):
                some = qs.iloc[s : s + 128]
                scores = np.array(some["v"].tolist(), np.float64) @ e.T
                for row, (query, cells) in zip(scores, zip(some["query_id"].tolist(), some["cells"], strict=True), strict=True):
                    row[~np.isin(names, cells)[at] | (ids == query)] = -np.inf
                    best = top(row, ids, k)
                    got[0].extend([query] * len(best))
                    got[1].extend(ids[best].tolist())
                    got[2].extend(row[best].tolist())
        return pd.DataFrame({"query_id": pd.Series(got[0], dtype="int64"), "vec_id": pd.Series(got[1], dtype="int64"), "score": pd.Series(got[2], dtype="float64")})

    found = probed.groupBy("part", "block").cogroup(placed.groupBy("part", "block")).applyInPandas(rerank, "query_id long, vec_id long, score double")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")).cast("int")
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
