"""Fingerprints, classifiers and slot maps against plain versions."""

import hashlib
import math
import random
import re

import numpy as np
import pytest

from ambermill.llm import queries as q
from ambermill.llm.fingerprints import differing_paragraphs, fingerprint, fingerprint_documents
from ambermill.llm.hashing import SHAPES, text_batches, word_hashes
from ambermill.llm.quality import FtrlLogistic, batch_features, train_quality
from ambermill.llm.sharding import SlotMap, slot_totals, sized
from ambermill.llm.toxicity import BITS, GRAMS, PIECE, NbLinear, fit_nb_linear, gram_features, train_toxicity
from pyspark.sql import functions as F


def node(s):
    return hashlib.sha256(s.encode()).hexdigest()[:16]


def clauses(line):
    """Shortest runs that end in punctuation before white space or at the line's end, or of 160 characters."""
    out, at = [], 0
    while at < len(line):
        end = min(at + 160, len(line))
        for i in range(at, end):
            rest = line[i + 1 :]
            if not (line[i].isalnum() or line[i].isspace()) and (not rest or rest[0].isspace()):
                end = i + 1
                while end < len(line) and line[end].isspace():
                    end += 1
                break
        out.append(line[at:end])
        at = end
    return out


def plain_tree(text):
    return [[node(c) for c in clauses(line)] for line in text.split("\n")] if text else []


def plain_print(text):
    tree = [(node(".".join(p)), p) for p in plain_tree(text)]
    root = hashlib.sha256("/".join(n for n, _ in tree).encode()).hexdigest()
    return f"{root}:" + "/".join(f"{n}={'.'.join(p)}" for n, p in tree)


def plain_likeness(a, b):
    x, y = ({n for s in plain_tree(t) for n in s} for t in (a, b))
    return 2 * len(x & y) / (len(x) + len(y)) if x or y else 1.0


TEXTS = ["", "One. Two, three!\nFour; five", "One. Two, three!\nFour; six", "Four; five\nOne. Two, three!", "a" * 400 + ". b", "x\n\ny.\n", "One. Two, three!\nFour; five\nFour; five", "no end"]


def test_fingerprints_against_a_plain_tree(spark):
    rows = list(enumerate(TEXTS))
    got = {r.doc_id: r for r in fingerprint_documents(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for i, t in rows:
        following = TEXTS[i - 1]
        edited = t[: len(t) - len(t) // 3] + following[: len(t) // 3]
        assert got[i].fingerprint == plain_print(t) and got[i].edited_fingerprint == plain_print(edited)
        assert got[i].near_edited == pytest.approx(plain_likeness(t, edited)) and got[i].near_next == pytest.approx(plain_likeness(t, following))
    with pytest.raises(TypeError):
        fingerprint_documents(spark.createDataFrame([("a", "x")], "doc_id string, text string"))


def test_differing_branches_locate_edits(spark):
    pairs = [(a, b) for a in TEXTS for b in TEXTS]
    df = spark.createDataFrame(pairs, "a string, b string").select("a", "b", fingerprint(F.col("a")).alias("x"), fingerprint(F.col("b")).alias("y"))
    for r in df.select("a", "b", differing_paragraphs(F.col("x"), F.col("y")).alias("d")).collect():
        x, y = plain_tree(r.a), plain_tree(r.b)
        at = lambda t, i, j: t[i][j] if i < len(t) and j < len(t[i]) else None
        places = {(i, j) for t in (x, y) for i, s in enumerate(t) for j in range(len(s))}
        assert [tuple(d) for d in r.d] == sorted((i, j) for i, j in places if at(x, i, j) != at(y, i, j)), (r.a, r.b)
    swapped = df.where(F.col("a") == TEXTS[1]).where(F.col("b") == TEXTS[3]).select(differing_paragraphs(F.col("x"), F.col("y")).alias("d")).first().d
    assert len(swapped) == 6  # three clauses and two, one section each, changed places


def plain_grams(text, n, bits):
    """Hash of each character n-gram, one character after the other."""
    out, mask = set(), (1 << 32) - 1
    padded = re.sub("[\x00\t-\r]", " ", f" {text.lower()} ")
    for i in range(len(padded) - n + 1):
        h = 0
        for c in padded[i : i + n]:
            h = ((h ^ ord(c)) * 0x9E3779B1) & mask
            h ^= h >> 15
        out.add((((h + n) * 0x85EBCA6B) & mask) >> (32 - bits))
    return out


def test_character_grams():
    texts = ["Some Text", "", "Größe — 日本語の文章 🙂", "a", "x\ty\nz", "long " * (PIECE // 4)]
    own, feature = gram_features(texts)
    for i, t in enumerate(texts):
        assert set(feature[own == i].tolist()) == set().union(*[plain_grams(t, n, BITS) for n in GRAMS])


def test_toxicity_against_plain_counts(spark):
    rng = random.Random(3)
    good, bad = ["kind", "warm", "bright", "calm"], ["awful", "nasty", "vile", "rotten"]
    rows = [(i, " ".join(rng.choices((bad if i % 3 == 0 else good) + ["the", "a", "text"], k=12)), int(i % 3 == 0)) for i in range(150)]
    texts, y = [r[1] for r in rows], [r[2] for r in rows]
    sets = [set().union(*[plain_grams(t, n, BITS) for n in GRAMS]) for t in texts]
    pos, all_ = {}, {}
    for s, label in zip(sets, y, strict=True):
        for f in s:
            all_[f] = all_.get(f, 0) + 1
            pos[f] = pos.get(f, 0) + label
    ratio = {}
    for f, n in all_.items():
        p, other = pos[f] + 1, n - pos[f] + 1
        r = math.log(p / (sum(y) + 2)) - math.log(other / (len(y) - sum(y) + 2))
        r = math.copysign(max(0.0, abs(r) - 2 * math.sqrt(1 / p + 1 / other)), r)
        if n >= 3 and r:
            ratio[f] = r
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, label) for i, _, label in rows] + [(10**6, 1), (None, 1), (3, None)], "doc_id long, toxic int")
    model, held = train_toxicity(docs, labels), fit_nb_linear(texts, y)
    assert np.allclose(model.weight, held.weight, atol=1e-5) and abs(model.bias - held.bias) < 1e-6
    used = np.flatnonzero(model.weight)
    assert set(used.tolist()) <= ratio.keys() and len(used) > 0.9 * len(ratio)
    # a weight is the ratio times a coefficient; scores are the sigmoid of the bias and the weights present
    for t, s in zip(texts[:20], sets, strict=False):
        margin = model.bias + sum(float(model.weight[f]) for f in s)
        assert model.scores([t])[0] == pytest.approx(1 / (1 + math.exp(-margin)), abs=1e-6)
    assert (model.scores(texts) >= 0.3).astype(int).tolist() == y


def test_one_class_or_no_labels(spark):
    docs = spark.createDataFrame([(1, "a text"), (2, "one more"), (2, "one more of the same id")], "doc_id long, text string")
    for rows in ([], [(1, 1), (2, 1), (2, 1)]):
        labels = spark.createDataFrame([(i, v, v) for i, v in rows], "doc_id long, toxic int, quality int")
        share = (len({i for i, _ in rows}) + 1) / (len({i for i, _ in rows}) + 2) if rows else 0.5
        assert train_toxicity(docs, labels).scores(["anything", ""]) == pytest.approx([share] * 2)
        assert 0 <= train_quality(docs, labels).score(np.array([1, 2])) <= 1


def test_ftrl_steps_against_the_formula():
    model = FtrlLogistic(bits=4)
    z, n, w = [0.0] * 17, [0.0] * 17, [0.0] * 17
    rng = random.Random(5)
    for _ in range(60):
        features, label = sorted(rng.sample(range(16), rng.randrange(1, 5))), rng.randrange(2)
        x = {f: 1 / math.sqrt(len(features)) for f in features} | {16: 1.0}
        for f in x:
            w[f] = 0.0 if abs(z[f]) <= model.l1 else -(z[f] - math.copysign(model.l1, z[f])) / ((model.beta + math.sqrt(n[f])) / model.alpha + model.l2)
        p = 1 / (1 + math.exp(-sum(w[f] * v for f, v in x.items())))
        assert model.update(np.array(features), label) == pytest.approx(p)
        for f, v in x.items():
            g = (p - label) * v
            sigma = (math.sqrt(n[f] + g * g) - math.sqrt(n[f])) / model.alpha
            z[f] += g - sigma * w[f]
            n[f] += g * g
    assert np.allclose(model.z, z) and np.allclose(model.n, n)
    frozen = model.frozen()
    some = np.array([2, 5, 7])
    margin = frozen.bias + sum(float(frozen.weight[f]) for f in some) / math.sqrt(3)
    assert frozen.score(some) == pytest.approx(1 / (1 + math.exp(-margin)))


def test_word_features_are_words_and_pairs():
    """Distinct words and adjacent pairs, and one more feature where a word comes twice running."""
    for text, count in (("one two three", 5), ("one two, one", 6), ("go go", 3), ("", 0), ("a-b", 5)):
        assert len(batch_features([text])[0]) == count, text
    data, _ = text_batches(["one two"])
    assert len(word_hashes(data, SHAPES)[0]) == 2
    assert [x.tolist() for x in batch_features(["one two", "three"])] == [batch_features([t])[0].tolist() for t in ("one two", "three")]


def test_slot_maps(spark, sf, tmp_path):
    totals = {k: b for k, (b, _) in slot_totals(sized(q.texts(spark, sf), "text", "doc_id", 512)).items()}
    first = SlotMap.balanced(totals, 10, 512)
    grown = first.grown(totals)
    moved = [k for k in range(512) if first.shard_of[k] != grown.shard_of[k]]
    assert moved and all(grown.shard_of[k] == 10 for k in moved) and (grown.version, grown.shards) == (2, 11)
    assert max(grown.loads(totals)) <= max(first.loads(totals)) and grown.loads(totals)[10] <= 1.01 * sum(totals.values()) / 11
    rng = random.Random(1)
    uneven = SlotMap(7, 10, tuple(rng.choice((0, 0, 0, *range(10))) for _ in range(512)))
    even = uneven.rebalanced(totals)
    spread = lambda m: max(m.loads(totals)) - min(m.loads(totals))
    assert spread(even) < spread(uneven) / 4 and even.version == 8
    grown.save(spark, str(tmp_path))
    assert SlotMap.load(spark, str(tmp_path), 2) == grown
    with pytest.raises(Exception, match="already exists"):
        grown.save(spark, str(tmp_path))


def test_empty_model_scores_half():
    assert NbLinear(np.zeros(1 << BITS, np.float32), 0.0).scores(["x", ""]).tolist() == [0.5, 0.5]


def test_features_of_the_sample_stay_off_the_driver(spark, monkeypatch):
    """Beside Spark's own memory the driver gets counts and the model, but no lists of features of documents; the model is that of a fit in one process."""
    texts = [f"{'good fine' if i % 2 else 'bad awful'} text number {i} of some words" for i in range(60)]
    y = [i % 2 for i in range(60)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    labels = spark.createDataFrame([(i, v, v) for i, v in enumerate(y)], "doc_id long, toxic int, quality int")
    kind, seen = type(docs), []
    real = kind.toArrow
    monkeypatch.setattr(kind, "toArrow", lambda self: (seen.append(self.schema.simpleString()), real(self))[1])
    toxic, good = train_toxicity(docs, labels), train_quality(docs, labels)
    assert not any("array" in s for s in seen)
    held, plain = fit_nb_linear(texts, y), FtrlLogistic().fit([f.astype(np.int32) for f in batch_features(texts)], y).frozen()
    assert np.array_equal(toxic.weight, held.weight) and toxic.bias == held.bias
    assert np.array_equal(good.weight, plain.weight) and good.bias == plain.bias
