"""Links between documents that lack an id or repeat one."""

import random

import numpy as np
import pytest

import corpus_pipeline
from ambermill.llm import ngram_join
from ambermill.llm.ngram_join import EARLIER, SKETCH, cross_pairs, similar_documents, token_sets

WORDS = [f"w{i}" for i in range(100)]


def text(*changed):
    return " ".join("x" if i in changed else w for i, w in enumerate(WORDS))


def test_documents_without_id_link_and_connect(spark):
    # at 4 words and 85: one word changed links (93 of 101 sets' n-grams), two do not (89 of 105); the text without an id is between
    rows = [(1, text(30)), (None, text()), (2, text(60)), (None, "quite another text without an id"), (3, "and one with an id and other words")]
    got = {r.h: (r.doc_id, r.component_id) for r in similar_documents(spark.createDataFrame(rows, "doc_id long, text string"), width=4, percent=85).collect()}
    assert sorted(got.values(), key=str) == sorted([(1, 1), (None, 1), (2, 1), (None, None), (3, 3)], key=str)


def test_stage_keeps_one_row_of_each_group(spark):
    other, third = " ".join(f"v{i}" for i in range(50)), " ".join(f"u{i}" for i in range(50))
    rows = [(1, text(), "b"), (1, text(), "a"), (7, text(30), "a"), (None, text(60), "a"), (7, "a clean text of the same id", "a")]
    rows += [(None, other, "a"), (None, other, "a"), (None, other + " end", "a"), (9, third, "a"), (None, third + " end", "a"), (None, "", "a"), (None, "", "a"), (8, None, "a")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    out = corpus_pipeline.ngram_join(spark, docs, "")
    got = [tuple(r) for r in out.collect()]
    assert out.columns == docs.columns
    left = [r for r in got if r[1] and not r[1].startswith(other)]
    assert sorted(left, key=str) == [(1, text(), "a"), (7, "a clean text of the same id", "a"), (9, third, "a")]
    assert sum((r[1] or "").startswith(other) for r in got) == 1
    assert sorted((r for r in got if not r[1]), key=str) == sorted([(None, "", "a"), (None, "", "a"), (8, None, "a")], key=str)


@pytest.mark.parametrize("most", [EARLIER, 3])
def test_open_lists_make_a_pair_once(spark, monkeypatch, most):
    """A pair came up in each list that it shares, and twice where sizes are equal."""
    monkeypatch.setattr(ngram_join, "EARLIER", most)
    classes, keys = range(1, 13), [7 * k for k in range(20)]
    rows = [(k, c, 100, (k // 7 + c) % 4 > 0, c // 2) for c in classes for k in keys]
    lists = spark.createDataFrame(rows, "key long, id long, n long, holder boolean, root long").selectExpr("*", "false as grown")
    outline = spark.createDataFrame([(c, [0] * SKETCH) for c in classes], "h long, sketch array<long>")
    got = [tuple(r) for r in cross_pairs(lists, outline, 85)[0].collect()]
    assert set(got) == {(a, b) for a in classes for b in classes if a < b and a // 2 != b // 2}
    assert len(got) == len(set(got)) or most < EARLIER


def test_chains_of_near_copies_stay_whole(spark, monkeypatch):
    """Copies edited so that many pairs lie on either side of the threshold; a round of heads alone doesn't join them."""
    monkeypatch.setattr(ngram_join, "HEADS", 1)
    rng, texts = random.Random(3), []
    for g in range(3):
        base = [f"g{g}w{i}" for i in range(60)]
        for _ in range(40):
            at = set(rng.sample(range(60), rng.randrange(4)))
            texts.append(" ".join("x" if i in at else w for i, w in enumerate(base)))
    got = {r.doc_id: r.component_id for r in similar_documents(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), width=4, percent=85).collect()}
    sets, root = token_sets(texts, 4), list(range(len(texts)))
    for a in range(len(texts)):
        for b in range(a):
            shared = len(np.intersect1d(sets[a], sets[b]))
            if 100 * shared >= 85 * (len(sets[a]) + len(sets[b]) - shared):
                root = [min(root[a], root[b]) if r in (root[a], root[b]) else r for r in root]
    assert got == dict(enumerate(root))
