"""Toxicity: linear classifier on character n-grams scaled by naive Bayes log-count ratios."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ambermill.llm.common import chunks, column, unstash
from ambermill.llm.sampling import fit_sample, labelled_sample

BITS = 18
GRAMS = (4, 5)
MOST_ROWS = 8_000
THRESHOLD = 0.3
PIECE = 1 << 18  # characters


def code_points(texts: Sequence[str], overlap: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(code points, text number of each, -1 between texts) of the lower-cased texts, each with a blank on either side and white space as
    blanks. Longer texts come in pieces that overlap by so many characters, so memory doesn't grow with a text's length."""
    for i, text in enumerate(texts):
        padded = f" {text.lower()} "
        for at in range(0, max(1, len(padded) - overlap), PIECE):
            code = np.frombuffer(padded[at : at + PIECE + overlap].encode("utf-32-le", "surrogatepass"), np.uint32).copy()
            code[(code == 0) | ((code >= 9) & (code <= 13))] = 32
            yield code, np.full(len(code), i, np.int32)


def batched(parts: Iterator[tuple[np.ndarray, np.ndarray]], overlap: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pieces put together to about PIECE characters, with gaps that no n-gram crosses."""
    codes, numbers, held = [], [], 0
    gap = np.zeros(1, np.uint32), np.full(1, -1, np.int32)
    for code, number in parts:
        codes += [code, gap[0]]
        numbers += [number, gap[1]]
        held += len(code)
        if held >= PIECE:
            yield np.concatenate(codes), np.concatenate(numbers)
            codes, numbers, held = [], [], 0
    if codes:
        yield np.concatenate(codes), np.concatenate(numbers)


def gram_positions(texts: Sequence[str], bits: int = BITS, grams: Sequence[int] = GRAMS) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each n, and each batch of pieces: the hash of every n-gram of characters, and the number of its text (-1 across texts)."""
    overlap = max(grams) - 1
    for code, number in batched(code_points(texts, overlap), overlap):
        h = np.zeros(len(code), np.uint32)
        whole = number.copy()
        for n in range(1, max(grams) + 1):
            size = len(code) - n + 1
            if size <= 0:
                break
            h = (h[:size] ^ code[n - 1 :]) * np.uint32(0x9E3779B1)
            h ^= h >> np.uint32(15)
            whole = np.where(number[n - 1 :] < 0, np.int32(-1), whole[:size])
            if n in grams:
                yield ((h + np.uint32(n)) * np.uint32(0x85EBCA6B)) >> np.uint32(32 - bits), whole


def gram_features(texts: Sequence[str], bits: int = BITS, grams: Sequence[int] = GRAMS, wanted: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(text number, feature) of the distinct n-grams of each text, ascending; of those that `wanted` marks, if given."""
    found = []
    for h, number in gram_positions(texts, bits, grams):
        at = np.flatnonzero(number >= 0 if wanted is None else (number >= 0) & wanted[h])
        found.append(np.unique((number[at].astype(np.int64) << bits) | h[at]))
    keys = np.unique(np.concatenate(found)) if found else np.empty(0, np.int64)
    return keys >> bits, keys & ((1 << bits) - 1)


def text_features(texts: Sequence[str], bits: int = BITS, wanted: np.ndarray | None = None) -> list[np.ndarray]:
    """The features of each text by themselves."""
    own, feature = gram_features(texts, bits, wanted=wanted)
    cut = np.searchsorted(own, np.arange(len(texts) + 1))
    return [feature[a:b] for a, b in zip(cut[:-1], cut[1:], strict=True)]


@dataclass
class NbLinear:
    """score(x) = sigmoid(bias + sum of weight over the features present), weight = ratio * coefficient."""

    weight: np.ndarray
    bias: float

    def scores(self, texts: Sequence[str]) -> np.ndarray:
        own, feature = gram_features(texts, int(len(self.weight)).bit_length() - 1, wanted=self.weight != 0)
        margin = self.bias + np.bincount(own, weights=self.weight[feature].astype(np.float64), minlength=len(texts))
        return 1 / (1 + np.exp(-np.clip(margin, -40, 40)))


def log_count_ratio(pos: np.ndarray, all_: np.ndarray, toxic: float, rows: float, smooth: float = 1.0, least: int = 3, shrink: float = 2.0) -> np.ndarray:
    """r = log(p/|p|) - log(q/|q|) of each feature, from the documents of either class that hold it, smoothed. Features in fewer than
    `least` documents get 0, and as a count is worth less the likelier it is by chance, r is shrunk by `shrink` standard errors."""
    p, q = pos + smooth, all_ - pos + smooth
    ratio = np.log(p / (toxic + 2 * smooth)) - np.log(q / (rows - toxic + 2 * smooth))
    return np.where(all_ >= least, np.sign(ratio) * np.maximum(0, np.abs(ratio) - shrink * np.sqrt(1 / p + 1 / q)), 0)


def fit_scaled(rows: Sequence[np.ndarray], labels: np.ndarray, ratio: np.ndarray, l2: float = 0.5, rounds: int = 60) -> NbLinear:
    """Logistic regression on presence features times their log-count ratio. rows: the features of each document, of those with a ratio.

    Full-batch gradient descent with per-feature steps (Adam). Without both classes the share of label 1 is the score.
    """
    y = np.asarray(labels, np.float64)
    if not len(y) or y.min() == y.max():
        share = (y.sum() + 1) / (len(y) + 2)
        return NbLinear(np.zeros(len(ratio), np.float32), float(np.log(share / (1 - share))))
    used = np.flatnonzero(ratio)
    place = np.zeros(len(ratio), np.int32)
    place[used] = np.arange(len(used), dtype=np.int32)
    at = place[np.concatenate(rows)]
    own = np.repeat(np.arange(len(rows), dtype=np.int32), [len(f) for f in rows])
    r = ratio[used]
    coef, bias = np.full(len(used), 0.1), float(np.log(y.mean() / (1 - y.mean())))
    m, v, mb, vb = np.zeros(len(used)), np.zeros(len(used)), 0.0, 0.0
    for step in range(1, rounds + 1):
        margin = bias + np.bincount(own, weights=(coef * r)[at], minlength=len(y))
        miss = 1 / (1 + np.exp(-np.clip(margin, -40, 40))) - y
        g = (np.bincount(at, weights=miss[own], minlength=len(used)) * r + l2 * coef) / len(y)
        gb = miss.mean()
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        mb, vb = 0.9 * mb + 0.1 * gb, 0.999 * vb + 0.001 * gb * gb
        a, b = 1 - 0.9**step, 1 - 0.999**step
        coef -= 0.1 * (m / a) / (np.sqrt(v / b) + 1e-8)
        bias -= 0.1 * (mb / a) / (np.sqrt(vb / b) + 1e-8)
    weight = np.zeros(len(ratio), np.float32)
    weight[used] = coef * r
    return NbLinear(weight, bias)


def fit_nb_linear(texts: Sequence[str], labels: Sequence[int], bits: int = BITS) -> NbLinear:
    """The classifier of texts held in memory."""
    y, rows = np.asarray(labels, np.float64), text_features(texts, bits)
    pos, all_ = np.zeros(1 << bits), np.zeros(1 << bits)
    for f, label in zip(rows, y, strict=True):
        pos[f] += label
        all_[f] += 1
    ratio = log_count_ratio(pos, all_, y.sum(), len(y))
    return fit_scaled([f[ratio[f] != 0] for f in rows], y, ratio)


def feature_counts(sample: DataFrame, bits: int = BITS) -> DataFrame:
    """f, pos, n: how many documents of label 1, and of any label, hold each feature. A task sends a row a feature at most."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pos, all_ = np.zeros(1 << bits, np.int64), np.zeros(1 << bits, np.int64)
        for part, texts in chunks(batches, "_text", 1 << 19):
            label = column(part, "_label").to_numpy()
            own, feature = gram_features(texts, bits)
            pos += np.bincount(feature[label[own] == 1], minlength=1 << bits)
            all_ += np.bincount(feature, minlength=1 << bits)
        f = np.flatnonzero(all_)
        yield pa.RecordBatch.from_arrays([pa.array(f, pa.int32()), pa.array(pos[f]), pa.array(all_[f])], names=["f", "pos", "n"])

    return sample.select("_label", "_text").mapInArrow(run, "f int, pos long, n long").groupBy("f").agg(F.sum("pos").alias("pos"), F.sum("n").alias("n"))


def train_toxicity(docs: DataFrame, labels: DataFrame, usable: Column | None = None, most_rows: int = MOST_ROWS, label: str = "toxic", text: str = "text", doc_id: str = "doc_id") -> NbLinear:
    """Fit on at most most_rows labelled documents; the text is the only input.

    Features are made and counted on the executors, and one task fits on those that have a ratio. The driver gets 2**BITS counts and the model.
    """
    sample = labelled_sample(docs, labels, label, F.lit(True) if usable is None else usable, most_rows, text, doc_id)
    counts = feature_counts(sample).toArrow()
    pos, all_ = np.zeros(1 << BITS), np.zeros(1 << BITS)
    pos[counts.column("f").to_numpy()] = counts.column("pos").to_numpy()
    all_[counts.column("f").to_numpy()] = counts.column("n").to_numpy()
    size = sample.agg(F.sum("_label").alias("toxic"), F.count(F.lit(1)).alias("rows")).first()
    ratio = log_count_ratio(pos, all_, size["toxic"] or 0, size["rows"])
    wanted = ratio != 0
    model = fit_sample(sample, lambda texts: text_features(texts, BITS, wanted), lambda rows, y: fit_scaled(rows, y, ratio))
    unstash(sample)
    return model


def score_toxicity(docs: DataFrame, model: NbLinear, text: str = "text", score: str = "score") -> DataFrame:
    """All columns of docs and the score, 0 to 1. NULL and empty texts get the score of no features.

    Rows are independent: repeated rows stay, an empty table gives an empty one. A column of the score's name is an error.
    The model (2**18 weights, 1 MB, whatever the corpus) goes to the executors with the function.
    """
    if score in docs.columns:
        raise ValueError(f"docs has a column {score!r} already")
    names = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in chunks(batches, text, 1 << 19):
            got = model.scores(texts)
            yield pa.RecordBatch.from_arrays([*[column(part, c) for c in names], pa.array(got, pa.float64())], names=[*names, score])

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField(score, T.DoubleType())]))
