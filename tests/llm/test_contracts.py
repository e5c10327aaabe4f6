"""The queries of the operators over the tables at SF, against plain versions."""

import hashlib
import re
import zlib

import numpy as np
import pytest

from ambermill.llm import queries as q


@pytest.fixture(scope="module")
def documents(spark):
    from conftest import SF

    return sorted(spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect())


@pytest.fixture(scope="module")
def tokenizer():
    import public_tokenizers
    from tokenizers import Tokenizer

    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def by_id(df):
    return {r["doc_id"]: r for r in df.collect()}


def sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


def test_op1(spark, sf, documents):
    rows = q.op1_line_dedup(spark, sf).collect()
    lines = {(d.doc_id, i): x.strip().lower() for d in documents for i, x in enumerate(d.text.split("\n")) if x.strip()}
    assert {(r.doc_id, r.line_no) for r in rows} == lines.keys() and len(rows) == len(lines)

    def shingles(x):
        return {x[i : i + 8] for i in range(max(1, len(x) - 7))}

    groups = {}
    for r in rows:
        groups.setdefault(r.component, []).append(r)
    for own in groups.values():
        first = min(own, key=lambda r: (r.doc_id, r.line_no))
        assert [r for r in own if r.kept] == [first]
    # equal lines are one; every larger component is held together by links
    of = {}
    for r in rows:
        assert of.setdefault(lines[r.doc_id, r.line_no], r.component) == r.component
    texts = {}
    for x, c in of.items():
        texts.setdefault(c, []).append(shingles(x))
    for own in texts.values():
        assert len(own) == 1 or all(any(a is not b and 10 * len(a & b) >= 8 * len(a | b) for b in own) for a in own)
    # recall of links between different lines
    sets = {x: shingles(x) for x in of}
    postings = {}
    for x in of:
        for t in sets[x]:
            postings.setdefault(t, []).append(x)
    true = []
    for a in of:
        shared = {}
        for t in sets[a]:
            for b in postings[t]:
                shared[b] = shared.get(b, 0) + 1
        true += [(a, b) for b, n in shared.items() if b != a and 10 * n >= 8 * (len(sets[a]) + len(sets[b]) - n)]
    assert true and sum(of[a] == of[b] for a, b in true) >= 0.98 * len(true)


def test_op2(spark, sf, documents):
    got = by_id(q.op2_ngram_jaccard(spark, sf))
    sets = {}
    for d in documents:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), d.text))
        sets[d.doc_id] = {tuple(w[i : i + 4]) for i in range(max(1, len(w) - 3))} if w else set()
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids, postings = sorted(sets), {}
    for i in ids:
        for t in sets[i]:
            postings.setdefault(t, []).append(i)
    for a in ids:
        shared = {}
        for t in sets[a]:
            for b in postings[t]:
                shared[b] = shared.get(b, 0) + 1
        for b, n in shared.items():
            if b < a and 100 * n >= 85 * (len(sets[a]) + len(sets[b]) - n):
                u, v = find(a), find(b)
                root[max(u, v)] = min(u, v)
    assert {i: (r.n_shingles, r.component_id) for i, r in got.items()} == {i: (len(sets[i]), find(i)) for i in ids}
    assert len({find(i) for i in ids}) < len(ids)


def test_op3(spark, sf, documents):
    got = by_id(q.op3_fingerprints(spark, sf))
    down = sorted(documents, key=lambda d: -d.doc_id)
    prints = {}
    for d, e in zip(down, down[1:] + down[:1], strict=True):
        r, n = got[d.doc_id], len(d.text)
        edited = d.text[: n - n // 3] + e.text[: n // 3]
        assert (r.n_chars, r.edited_sha256) == (n, sha(edited))
        assert prints.setdefault(d.text, r.fingerprint) == r.fingerprint
        assert (r.fingerprint == r.edited_fingerprint) == (d.text == edited)
        assert 0 <= r.near_next <= 1 and 0 <= r.near_edited <= 1
    assert len(set(prints.values())) == len(prints)
    wide = [r for r in got.values() if r.n_chars > 200]
    assert np.mean([r.near_edited > r.near_next for r in wide]) > 0.95


def test_op4(spark, sf, documents):
    got = by_id(q.op4_sharding(spark, sf))
    slots = {}
    for d in documents:
        r, raw = got[d.doc_id], d.text.encode()
        assert (r["size"], r.text_crc32, r.law, r.grown_shard) == (len(raw) + 16, zlib.crc32(raw), "bytes", None)
        slots.setdefault(r.shard, []).append((r.slot, r["size"]))
    assert slots.keys() == set(range(40))
    for own in slots.values():
        assert sorted(s for s, _ in own) == list(range(len(own)))
    loads = [sum(n for _, n in own) for own in slots.values()]
    assert max(loads) - min(loads) <= 0.02 * np.mean(loads)


def test_op5_op6(spark, sf, documents, tokenizer):
    got, counted = by_id(q.op5_bpe_automaton(spark, sf)), by_id(q.op6_token_counts(spark, sf))
    for d, e in zip(documents, tokenizer.encode_batch([d.text for d in documents], add_special_tokens=False), strict=True):
        r = got[d.doc_id]
        assert (r.n_tokens, r.ids_sha256) == (len(e.ids), sha(",".join(map(str, e.ids))))
        assert r.decoded_sha256 == sha(tokenizer.decode(e.ids, skip_special_tokens=False))
        c = counted[d.doc_id]
        assert (c.n_bytes, c.n_tokens, c.over_limit) == (len(d.text.encode()), len(e.ids), len(e.ids) > 1024)


def auc(scores, labels):
    order = np.argsort(scores)
    rank = np.empty(len(order))
    rank[order] = np.arange(len(order))
    y = np.asarray(labels) == 1
    return (rank[y].sum() - y.sum() * (y.sum() - 1) / 2) / (y.sum() * (~y).sum())


@pytest.mark.parametrize(("name", "label", "folds", "held", "cut"), [("op7_toxicity", "toxic", 4, 2, 0.3), ("op8_quality", "quality", 3, 1, 0.5)])
def test_op7_op8(spark, sf, documents, name, label, folds, held, cut):
    got = by_id(q.queries()[name](spark, sf))
    assert got.keys() == {d.doc_id for d in documents}
    for i, r in got.items():
        assert r.held_out == (zlib.crc32(str(i).encode()) % folds == held)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= cut)
    rows = [r for r in spark.read.parquet(f"{sf}/labels.parquet").collect() if got[r.doc_id].held_out]
    assert auc([got[r.doc_id].score for r in rows], [r[label] for r in rows]) > 0.85


def test_op9(spark, sf):
    rows = q.op9_multi_index(spark, sf).collect()
    data = sorted(spark.read.parquet(f"{sf}/embeddings.parquet").select("vec_id", "embedding").collect())
    ids, x = np.array([r.vec_id for r in data]), np.array([r.embedding for r in data], np.float64)
    found = {}
    for r in rows:
        found.setdefault(r.query_id, []).append(r)
    assert found.keys() == {i for i in ids.tolist() if i % 20 == 0}
    hits = total = 0
    for i, own in found.items():
        own.sort(key=lambda r: r["rank"])
        assert [r["rank"] for r in own] == list(range(1, 21))
        s = x @ x[ids == i][0]
        assert all(abs(r.score - s[ids == r.vec_id][0]) < 1e-12 for r in own)
        assert own == sorted(own, key=lambda r: (-r.score, r.vec_id))
        s[ids == i] = -9
        best = set(ids[np.lexsort((ids, -s))[:20]].tolist())
        hits, total = hits + len(best & {r.vec_id for r in own}), total + 20
    assert hits >= 0.9 * total


def test_op10(spark, sf, documents, tokenizer):
    rows = q.op10_packing(spark, sf).collect()
    pieces, sequences = {}, {}
    for r in rows:
        pieces.setdefault(r.doc_id, []).append(r)
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for d, e in zip(documents, tokenizer.encode_batch([d.text for d in documents], add_special_tokens=False), strict=True):
        ids, at = [*e.ids, 0], 0
        for r in sorted(pieces[d.doc_id], key=lambda r: r.start):
            assert (r.start, r.doc_tokens) == (at, len(ids))
            assert r.ids_crc32 == zlib.crc32(np.array(ids[at : at + r.length], "<u4").tobytes())
            at += r.length
        assert at == len(ids)
    filled = 0
    for own in sequences.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= 1024
        filled += at
    assert filled >= 0.98 * 1024 * len(sequences)
