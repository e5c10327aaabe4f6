"""Very long texts and words, and large groups: results are whole, and work grows about with the text."""

import random
import time

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from ambermill.llm import common
from ambermill.llm.bpe_automaton import automaton, encode_documents
from ambermill.llm.fingerprints import fingerprint_documents
from ambermill.llm.ngram_join import similar_documents
from ambermill.llm.packing import pack_documents
from ambermill.llm.quality import FtrlLogistic, score_quality
from ambermill.llm.sharding import shard_documents
from ambermill.llm.token_counts import LONG, count_tokens, merger
from ambermill.llm.toxicity import fit_nb_linear, score_toxicity

RNG = random.Random(1)
WORD = "".join(RNG.choices("abcdefghijklmnopqrstuvwxyzéß", k=200_000))
WORDS = " ".join("".join(RNG.choices("abcdefgh", k=RNG.randrange(1, 7))) for _ in range(60_000))


@pytest.fixture(scope="module")
def long(spark):
    return spark.createDataFrame([(1, WORD), (2, WORDS), (3, "\n" * 50_000 + "x"), (4, "short")], "doc_id long, text string")


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def test_tokens(long, tokenizer):
    ids = {r.doc_id: tokenizer.encode(r.text, add_special_tokens=False).ids for r in long.collect()}
    made = {r.doc_id: r for r in encode_documents(long, decoded=True).collect()}
    texts = {r.doc_id: r.text for r in long.collect()}
    assert all(made[i].ids == ids[i] and made[i].decoded == texts[i] for i in ids)
    assert {r.doc_id: r.n_tokens for r in count_tokens(long).collect()} == {i: len(x) for i, x in ids.items()}
    packed = pack_documents(long).groupBy("doc_id").agg(F.sum("length").alias("n")).collect()
    assert {r.doc_id: r.n for r in packed} == {i: len(x) + 1 for i, x in ids.items()}


@pytest.mark.parametrize("word", [WORD[:LONG], WORD[: LONG + 1], "a" * 3000, "ab" * 2000, "=-" * 999 + "=", WORD[:5000]])
def test_long_words_are_merged_as_short_ones(tokenizer, word):
    m = merger()
    assert m.count_long(word.encode()) == int(m.counts([word.encode()])[0]) == len(tokenizer.encode(word, add_special_tokens=False).ids)


def test_time_on_a_word_of_ten_times_the_length():
    machine, counter = automaton(), merger()
    for run in (lambda w: machine.encode_word(w), lambda w: counter.count_long(w)):
        took = []
        for n in (20_000, 200_000):
            began = time.process_time()
            run(WORD.encode()[:n])
            took.append(time.process_time() - began)
        assert took[1] < 40 * max(took[0], 0.02) and took[1] < 20


def test_classifiers_see_the_whole_text(spark):
    """The score is that of the whole text's features, in whatever pieces it is read."""
    model = fit_nb_linear(["awful nasty text", "kind friendly text"] * 40, [1, 0] * 40)
    docs = spark.createDataFrame([(1, "x " * 300_000 + "awful nasty"), (2, "x " * 300_000), (3, "x " * 300_000 + "kind friendly")], "doc_id long, text string")
    got = {r.doc_id: r.score for r in score_toxicity(docs, model).collect()}
    assert got[1] > got[2] > got[3]
    assert len({round(r.score, 9) for r in score_quality(docs, FtrlLogistic().frozen()).collect()}) == 1


def test_fingerprints_and_shards(long):
    made = {r.doc_id: r for r in fingerprint_documents(long).collect()}
    assert {i: r.n_chars for i, r in made.items()} == {1: len(WORD), 2: len(WORDS), 3: 50_001, 4: 5}
    assert all(0 <= r.near_edited <= 1 and len(r.fingerprint.split(":")[0]) == 64 for r in made.values())
    assert sorted(r["size"] for r in shard_documents(long, 2).collect()) == sorted(len(t.encode()) + 16 for t in (WORD, WORDS, "\n" * 50_000 + "x", "short"))


def plain_components(sets, percent):
    root = list(range(len(sets)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(sets)):
        for j in range(i):
            n = len(sets[i] & sets[j])
            if n and 100 * n >= percent * (len(sets[i]) + len(sets[j]) - n):
                u, v = find(i), find(j)
                root[max(u, v)] = min(u, v)
    return [find(i) for i in range(len(sets))]


@pytest.mark.parametrize("most", [-1, 16 << 20])
def test_large_groups_of_near_copies(spark, monkeypatch, most):
    """300 copies edited in one to five places, and 60 documents that share a long passage; also with no broadcast at all."""
    monkeypatch.setattr(common, "BROADCAST_BYTES", most)
    rng = random.Random(9)
    source = [f"w{rng.randrange(10**6)}" for _ in range(150)]
    texts = [" ".join(source)]
    for _ in range(300):
        x = list(source)
        for at in rng.sample(range(150), rng.randrange(1, 6)):
            x[at] = f"e{rng.randrange(10**6)}"
        texts.append(" ".join(x))
    passage = " ".join(f"p{i}" for i in range(60))
    texts += [f"{passage} " + " ".join(f"q{rng.randrange(10**6)}" for _ in range(rng.randrange(5, 200))) for _ in range(60)]
    words = [t.split() for t in texts]
    sets = [{tuple(w[i : i + 4]) for i in range(len(w) - 3)} for w in words]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in similar_documents(docs, width=4, percent=85).collect()}
    want = plain_components(sets, 85)
    assert got == dict(enumerate(want)) and 2 < len(set(want)) < len(texts) - 50


def test_two_whole_books(spark):
    words = WORDS.split()
    other = list(words)
    for at in range(0, len(other), 400):
        other[at] = "edited"
    docs = spark.createDataFrame([(1, " ".join(words)), (2, " ".join(other)), (3, " ".join(words[: len(words) // 2]))], "doc_id long, text string")
    assert {r.doc_id: r.component_id for r in similar_documents(docs).collect()} == {1: 1, 2: 1, 3: 3}
