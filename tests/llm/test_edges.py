"""Defined results for nulls, empty texts, repeated rows, further columns and empty tables."""

import pytest
from pyspark.sql import functions as F

from ambermill.llm.bpe_automaton import encode_documents
from ambermill.llm.fingerprints import fingerprint_documents
from ambermill.llm.line_dedup import dedup_lines, drop_duplicate_lines
from ambermill.llm.ngram_join import similar_documents
from ambermill.llm.packing import pack_documents
from ambermill.llm.quality import FtrlLogistic, score_quality
from ambermill.llm.sharding import shard_documents
from ambermill.llm.token_counts import count_tokens
from ambermill.llm.toxicity import fit_nb_linear, score_toxicity
from ambermill.llm.vector_search import nearest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, n int, h string, score_x double"
LONG = "a long text of many words that goes on and on " * 3
OPERATORS = {
    "line_dedup": dedup_lines,
    "ngram_join": similar_documents,
    "fingerprints": fingerprint_documents,
    "sharding": lambda d: shard_documents(d, 3),
    "bpe": lambda d: encode_documents(d, decoded=True),
    "token_counts": count_tokens,
    "toxicity": lambda d: score_toxicity(d, fit_nb_linear(["bad", "good"] * 4, [1, 0] * 4)),
    "quality": lambda d: score_quality(d, FtrlLogistic().frozen()),
    "packing": pack_documents,
}


@pytest.fixture(scope="module")
def odd(spark):
    """Texts NULL, empty, blank and repeated; a NULL id; columns with names that operators use themselves."""
    rows = [(1, None), (2, ""), (3, " \n\t\n"), (4, LONG), (4, LONG), (5, LONG + "x"), (None, "one of no id"), (6, "short"), (None, None)]
    return spark.createDataFrame([(i, t, None, None, None, 1, "h", 0.5) for i, t in rows], SCHEMA)


@pytest.mark.parametrize("name", sorted(OPERATORS))
def test_empty_table(spark, name):
    assert OPERATORS[name](spark.createDataFrame([], SCHEMA)).collect() == []


@pytest.mark.parametrize("name", sorted(set(OPERATORS) - {"line_dedup", "packing"}))
def test_one_row_a_document(odd, name):
    got = [r["doc_id"] for r in OPERATORS[name](odd).collect()]
    assert sorted(got, key=str) == sorted([r["doc_id"] for r in odd.collect()], key=str)


def test_lines(odd):
    rows = dedup_lines(odd).collect()
    assert {r.doc_id for r in rows} == {4, 5, None, 6}
    assert {r.doc_id for r in rows if not r.kept} == {5}
    kept = drop_duplicate_lines(odd)
    assert kept.columns == odd.columns and kept.count() == odd.count()
    assert {r.text for r in kept.where("doc_id = 5").collect()} == {""}
    assert {r.text for r in kept.where("doc_id = 1").collect()} == {None}


def test_links(odd):
    got = {(r.doc_id, r.n_shingles > 0, r.component_id) for r in similar_documents(odd).collect()}
    assert {(1, False, 1), (2, False, 2), (3, False, 3), (4, True, 4), (6, True, 6)} <= got


def test_counts(odd):
    got = {r.doc_id: (r.n_bytes, r.n_tokens) for r in count_tokens(odd.where("doc_id is not null")).collect()}
    assert got[1] == got[2] == (0, 0) and got[6][0] == 5


def test_packs_every_row(odd):
    got = pack_documents(odd).groupBy("doc_id").agg(F.sum(F.lit(1)).alias("n")).collect()
    assert {r.doc_id: r.n for r in got} == {1: 1, 2: 1, 3: 1, 4: 2, 5: 1, 6: 1, None: 2}


def test_vectors(spark):
    rows = [(0, [1.0, 0.0]), (1, None), (2, [0.0, 0.0]), (3, [None, 1.0]), (4, [float("nan"), 1.0]), (5, [2.0, 0.0]), (6, [1.0, 1.0]), (7, [1.0, 3.0]), (None, [1.0, 1.0])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = [(r.query_id, r["rank"], r.vec_id, r.score) for r in nearest(table, F.col("vec_id") % 20 == 0).collect()]
    assert sorted(got) == [(0, 1, 5, 2.0), (0, 2, 6, 1.0), (0, 3, 7, 1.0)]
    assert nearest(table.limit(0), F.col("vec_id") % 20 == 0).collect() == []
