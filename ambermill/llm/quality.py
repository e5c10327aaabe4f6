"""Quality classifier: hashed word n-grams, logistic regression by follow-the-regularised-leader."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ambermill.llm.common import chunks, column, unstash
from ambermill.llm.hashing import SHAPES, splitmix, text_batches, word_hashes
from ambermill.llm.sampling import fit_sample, labelled_sample

BITS = 20
MOST_ROWS = 12_000
THRESHOLD = 0.5
REPEATED = splitmix(np.array([2**63 + 1], np.uint64))


def word_features(words: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Distinct hashed words and word pairs of a sequence of word hashes; a word twice running is also the pair "repeated"."""
    drop = np.uint64(64 - bits)
    pairs = splitmix(words[:-1] ^ (words[1:] << np.uint64(1)) ^ (words[1:] >> np.uint64(63)))
    again = REPEATED[: int((words[1:] == words[:-1]).any())]
    return np.unique(np.r_[words >> drop, pairs >> drop, again >> drop].astype(np.int64))


def batch_features(texts: list[str], bits: int = BITS) -> list[np.ndarray]:
    """word_features of each text; runs of letters and digits are words, and so are runs of punctuation. Case counts."""
    data, starts = text_batches(texts)
    hashes, at = word_hashes(data, SHAPES)
    cut = np.searchsorted(at, starts)
    return [word_features(hashes[a:b], bits) for a, b in zip(cut[:-1], cut[1:], strict=True)]


@dataclass
class FtrlLogistic:
    """Weights follow from the sums z and n of each coordinate; weights whose |z| stays within l1 are 0."""

    bits: int = BITS
    alpha: float = 2.0
    beta: float = 1.0
    l1: float = 0.02
    l2: float = 0.01
    z: np.ndarray = field(default=None, repr=False)
    n: np.ndarray = field(default=None, repr=False)

    def __post_init__(self) -> None:
        if self.z is None:
            self.z, self.n = np.zeros((1 << self.bits) + 1), np.zeros((1 << self.bits) + 1)

    def weights(self, at: np.ndarray) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        w = -(z - np.sign(z) * self.l1) / ((self.beta + np.sqrt(n)) / self.alpha + self.l2)
        return np.where(np.abs(z) <= self.l1, 0.0, w)

    def update(self, features: np.ndarray, label: int) -> float:
        """One step on a document; the last coordinate is the bias. Returns the score before the step."""
        at = np.r_[features, 1 << self.bits]
        x = np.full(len(at), 1 / np.sqrt(max(1, len(features))))
        x[-1] = 1.0
        w = self.weights(at)
        p = 1 / (1 + np.exp(-np.clip(w @ x, -40, 40)))
        g = (p - label) * x
        n = self.n[at]
        sigma = (np.sqrt(n + g * g) - np.sqrt(n)) / self.alpha
        self.z[at] += g - sigma * w
        self.n[at] = n + g * g
        return float(p)

    def fit(self, rows: Sequence[np.ndarray], labels: Sequence[int], least_steps: int = 24_000, seed: int = 7) -> FtrlLogistic:
        """Passes in random order until at least least_steps documents were seen, three at least."""
        passes = max(3, -(-least_steps // max(1, len(rows))))
        rng = np.random.default_rng(seed)
        for _ in range(passes):
            for i in rng.permutation(len(rows)):
                self.update(rows[i], labels[i])
        return self

    def frozen(self) -> SparseScorer:
        w = self.weights(np.arange((1 << self.bits) + 1))
        return SparseScorer(w[:-1].astype(np.float32), float(w[-1]))


@dataclass
class SparseScorer:
    weight: np.ndarray
    bias: float

    def score(self, features: np.ndarray) -> float:
        margin = self.bias + self.weight[features].sum(dtype=np.float64) / np.sqrt(max(1, len(features)))
        return float(1 / (1 + np.exp(-np.clip(margin, -40, 40))))


def train_quality(docs: DataFrame, labels: DataFrame, usable: Column | None = None, most_rows: int = MOST_ROWS, label: str = "quality", text: str = "text", doc_id: str = "doc_id") -> SparseScorer:
    """Fit on at most most_rows labelled documents; the text is the only input. Hashing is done on the executors, and the steps in one task."""
    sample = labelled_sample(docs, labels, label, F.lit(True) if usable is None else usable, most_rows, text, doc_id)
    model = fit_sample(sample, batch_features, lambda rows, y: FtrlLogistic().fit(rows, y.tolist()).frozen())
    unstash(sample)
    return model


def score_quality(docs: DataFrame, model: SparseScorer, text: str = "text", score: str = "score") -> DataFrame:
    """All columns of docs and the score, 0 to 1. NULL and empty texts get the score of no features (the bias).

    Rows are independent: repeated rows stay, an empty table gives an empty one. A column of the score's name is an error.
    The model has 2**20 weights (4 MB), whatever the corpus.
    """
    if score in docs.columns:
        raise ValueError(f"docs has a column {score!r} already")
    names = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in chunks(batches, text, 1 << 19):
            got = [model.score(f) for f in batch_features(texts)]
            yield pa.RecordBatch.from_arrays([*[column(part, c) for c in names], pa.array(got, pa.float64())], names=[*names, score])

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField(score, T.DoubleType())]))
