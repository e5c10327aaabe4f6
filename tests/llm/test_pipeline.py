"""The pipeline's stages against plain versions, and on odd tables."""

import re

import corpus_pipeline as pipeline
import pyarrow.parquet as pq
import pytest
from ambermill import session
from ambermill.llm.quality import score_quality, train_quality
from ambermill.llm.toxicity import score_toxicity, train_toxicity

SMALL = "/root/testdata/sf0.001"
KIND = "doc_id long, text string, lang string, source string, n_chars long, _k int, _gone string, _row string, _toxicity int, _quality int, _id int, _lines int"


def read(spark, name):
    return spark.read.parquet(f"{SMALL}/{name}.parquet")


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def plain_join(rows):
    """Ids that stay: the least of each group linked at 0.8."""
    sets, root = [shingles(t) for _, t in rows], list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            n = len(sets[i] & sets[j])
            if n and 10 * n >= 8 * (len(sets[i]) + len(sets[j]) - n):
                u, v = find(i), find(j)
                root[max(u, v)] = min(u, v)
    return {rows[i][0] for i in range(len(rows)) if find(i) == i}


def plain_lines(rows):
    """Texts without lines that are near an earlier one of their component, by comparing all lines."""
    lines = [(i, n, x.strip(" \t\r\x0b\x0c").lower()) for i, (_, t) in enumerate(rows) for n, x in enumerate((t or "").split("\n"))]
    lines = [x for x in lines if x[2]]
    different = sorted({x[2] for x in lines})
    sets = [{x[k : k + 8] for k in range(max(1, len(x) - 7))} for x in different]
    root = {x: x for x in different}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(different)):
        for j in range(i):
            if 10 * min(len(sets[i]), len(sets[j])) >= 8 * max(len(sets[i]), len(sets[j])):
                n = len(sets[i] & sets[j])
                if 10 * n >= 8 * (len(sets[i]) + len(sets[j]) - n):
                    root[find(different[i])] = find(different[j])
    seen, gone = set(), {}
    for i, n, x in lines:
        c = find(x)
        if c in seen:
            gone.setdefault(i, set()).add(n)
        seen.add(c)
    return ["\n".join(x for n, x in enumerate(t.split("\n")) if n not in gone.get(i, ())) if t else t for i, (_, t) in enumerate(rows)]


def test_every_stage_on_the_one_before(spark, tmp_path):
    docs = read(spark, "documents")
    columns, all_docs, labels = docs.columns, docs, read(spark, "labels")
    stages = dict(pipeline.STAGES)
    assert list(stages) == ["toxicity", "quality", "line_dedup", "ngram_join", "packing"]

    def step(name, before):
        stages[name](spark, before, SMALL).write.parquet(str(tmp_path / name))
        return spark.read.parquet(str(tmp_path / name))

    clean = step("toxicity", docs)
    scores = {r.doc_id: r.score for r in score_toxicity(docs, train_toxicity(all_docs, labels)).collect()}
    assert {r.doc_id for r in clean.collect()} == {i for i, s in scores.items() if s < 0.3} and clean.columns == columns
    toxic = {r.doc_id for r in labels.collect() if r.toxic}
    assert sum(i in scores and scores[i] >= 0.3 for i in toxic) >= 0.9 * len(toxic)
    good = step("quality", clean)
    scores = {r.doc_id: r.score for r in score_quality(clean, train_quality(all_docs, labels)).collect()}
    assert {r.doc_id for r in good.collect()} == {i for i, s in scores.items() if s >= 0.5} and good.columns == columns
    lean = step("line_dedup", good)
    rows = sorted((r.doc_id, r.text) for r in good.collect())
    got = {r.doc_id: r.text for r in lean.collect()}
    want = dict(zip([i for i, _ in rows], plain_lines(rows), strict=True))
    assert lean.columns == columns and got.keys() == want.keys() and sum(got[i] == want[i] for i in got) >= 0.97 * len(got)
    assert all(r.n_chars == len(r.text) for r in lean.collect())
    single = step("ngram_join", lean)
    assert single.columns == columns and {r.doc_id for r in single.collect()} == plain_join(sorted(got.items()) if len(got) == lean.count() else [])
    texts = {r.doc_id: r.text for r in single.collect()}
    assert texts == {i: got[i] for i in texts}
    packed = step("packing", single).collect()
    assert {r.doc_id for r in packed} == texts.keys()
    room = {}
    for r in packed:
        room.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for own in room.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= 1024


def test_run_returns_the_last_stage_and_deletes_what_it_stored(spark):
    from ambermill.session import checkpoint_root

    rows = pipeline.run(spark, SMALL).collect()
    assert rows and pipeline.ORACLE_SQL is None
    assert checkpoint_root(spark)


@pytest.fixture
def odd(spark):
    text = " ".join(f"word{i}" for i in range(40))
    rows = [(1, None), (2, ""), (3, " \n\t\n"), (4, text), (4, text), (5, text + " end"), (None, text), (None, None), (6, "short"), (6, "other words of six")]
    return spark.createDataFrame([(i, t, None, None, None, 1, "g", "r", 1, 1, 1, 1) for i, t in rows], KIND)


@pytest.mark.parametrize("name", [n for n, _ in pipeline.STAGES])
def test_odd_and_empty_tables(spark, odd, name):
    stage = dict(pipeline.STAGES)[name]
    out = stage(spark, odd, SMALL)
    rows = out.collect()
    if name != "packing":
        assert out.columns == odd.columns
    if name in ("toxicity", "quality"):
        count = lambda i, t: sum((r.doc_id, r.text) == (i, t) for r in rows)
        assert count(4, odd.where("doc_id = 4").first().text) in (0, 2)
    if name == "line_dedup":
        assert len(rows) == odd.count() and {r.text for r in rows if r.doc_id == 1} == {None} and {r.text for r in rows if r.doc_id == 5} == {""}
    if name == "ngram_join":
        left = sorted(((r.doc_id, r.text) for r in rows), key=str)
        assert len([x for x in left if x[1] and x[1].startswith("word0")]) == 1 and (4, odd.where("doc_id = 4").first().text) in left
        assert {(1, None), (2, ""), (3, " \n\t\n"), (None, None), (6, "short"), (6, "other words of six")} <= set(left)
    if name == "packing":
        assert len(rows) == odd.count()
    empty = stage(spark, odd.limit(0), SMALL)
    assert empty.collect() == []


def test_results_have_small_row_groups(spark, tmp_path, monkeypatch):
    """A stage's result with row groups of 128 MB, however it is written, didn't fit the next stage's heap."""
    reader = "spark.sql.parquet.columnarReaderBatchSize"
    for key in session.TASK_MEMORY:
        spark.conf.unset(key)
    spark.conf.set(reader, "64")
    monkeypatch.setitem(session.TASK_MEMORY, "parquet.block.size", str(64 << 10))
    try:
        pipeline.toxicity(spark, read(spark, "documents"), SMALL).coalesce(1).write.parquet(f"{tmp_path}/kept")
        (file,) = tmp_path.glob("kept/*.parquet")
        found = pq.ParquetFile(file).metadata
        assert found.num_row_groups > 1 and spark.conf.get(reader) == "64"
        assert spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == session.TASK_MEMORY["spark.sql.execution.arrow.maxRecordsPerBatch"]
    finally:
        for key in session.TASK_MEMORY:
            spark.conf.unset(key)
