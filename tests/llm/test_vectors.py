"""Recall of the walk against brute force, with the share of the index that it chooses for itself."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from ambermill.llm import vector_search
from ambermill.llm.vector_search import MultiIndex, nearest, share_for


def recall(table, **params):
    """Share of the true 20 nearest of each query found by the index."""
    rows = sorted((r.vec_id, r.embedding) for r in table.collect())
    ids, e = np.array([r[0] for r in rows]), np.array([r[1] for r in rows], np.float64)
    scores = e[ids % 20 == 0] @ e.T
    scores[np.arange(len(scores)), np.flatnonzero(ids % 20 == 0)] = -np.inf
    true = {(q, i) for q, at in zip(ids[ids % 20 == 0].tolist(), np.argsort(-scores, axis=1)[:, :20], strict=True) for i in ids[at].tolist()}
    got = {(r.query_id, r.vec_id) for r in nearest(table, F.col("vec_id") % 20 == 0, **params).collect()}
    return len(got & true) / len(true)


def clustered(n, seed=4):
    rng = np.random.default_rng(seed)
    centers = rng.normal(size=(60, 32))
    x = centers[rng.integers(0, 60, n)] + 0.9 * rng.normal(size=(n, 32))
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def test_recall_of_the_pruned_walk(spark):
    x = clustered(20_000)
    table = spark.createDataFrame([(i, v) for i, v in enumerate(x.tolist())], "vec_id long, embedding array<float>")
    index = MultiIndex.fit(x[::4])
    assert share_for(index, x[::4], 20, 0.95) < 0.45
    assert 0.9 <= recall(table, most_fit=5_000) < 1
    assert recall(table.where("vec_id < 700")) >= 0.9
    assert recall(table.where("vec_id < 700"), recall=1.0) >= 0.99


def test_the_walk_passes_cells_in_order():
    x = clustered(3_000)
    index = MultiIndex.fit(x)
    sizes = np.bincount(index.cells(x), minlength=len(index.first) * len(index.second))
    for q in x[:5]:
        reach = ((index.first @ q[:16])[:, None] + (index.second @ q[16:])[None, :]).ravel()
        got = index.walk(q, sizes, 900)
        want = [c for c in np.argsort(-reach, kind="stable").tolist() if sizes[c]]
        assert np.allclose(reach[got], reach[want[: len(got)]]) and sizes[got].sum() >= 900 > sizes[got[:-1]].sum()


@pytest.mark.parametrize("part", [64, 8_192])
def test_tiles_and_a_vector_that_a_third_of_all_rows_hold(spark, monkeypatch, part):
    monkeypatch.setattr(vector_search, "PART", part)
    monkeypatch.setattr(vector_search, "QUERIES", part)
    x = clustered(1_500)
    x[::3] = x[0]
    table = spark.createDataFrame([(i, v) for i, v in enumerate(x.tolist())], "vec_id long, embedding array<float>")
    rows = nearest(table, F.col("vec_id") % 20 == 0, recall=1.0).collect()
    e = np.array([r.embedding for r in table.orderBy("vec_id").collect()], np.float64)
    for q in (0, 20, 300):
        own = sorted((r["rank"], r.vec_id, r.score) for r in rows if r.query_id == q)
        s = e @ e[q]
        s[q] = -np.inf
        assert [r[0] for r in own] == list(range(1, 21)) and all(abs(r[2] - s[r[1]]) < 1e-12 for r in own)
        assert [r[1] for r in own] == np.lexsort((np.arange(len(s)), -s))[:20].tolist()
