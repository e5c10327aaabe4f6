"""Bounded samples of labelled documents for fitting."""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ambermill.llm.common import chunks, column, stash


def fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo the number of folds; NULL ids count as ''."""
    return F.crc32(F.encode(F.coalesce(doc_id.cast("string"), F.lit("")), "UTF-8")) % folds


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, usable: Column, most: int, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """_id, _label and the whole _text (NULL as empty) of at most `most` labelled documents, those with the least hash of their id; stored.

    usable says which rows of labels may be used. One row an id: the highest label, where an id has several, and the least text. The ids
    kept are at most `most`, so joining them to the documents by broadcast is bounded. Labels that are NULL, or without a document, play no part.
    """
    own = labels.where(usable & F.col(label).isNotNull() & F.col(doc_id).isNotNull()).select(doc_id, label)
    ids = own.groupBy(doc_id).agg(F.max(label).cast("int").alias("_label")).orderBy(F.xxhash64(doc_id), doc_id).limit(most)
    ids = ids.select(F.col(doc_id).alias("_id"), "_label")
    texts = docs.select(F.col(f"`{doc_id}`").alias("_id"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("_text"))
    return stash(texts.join(F.broadcast(ids), "_id").groupBy("_id", "_label").agg(F.min("_text").alias("_text")), "sample")


def fit_sample(sample: DataFrame, features: Callable[[list[str]], list[np.ndarray]], fit: Callable[[list[np.ndarray], np.ndarray], Any]) -> Any:
    """fit(features of each document as 32-bit integers, labels), by rising id. One task gets the features of the bounded sample and fits; of
    all that only the model reaches the driver, so that its memory doesn't hold the features beside Spark's own."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in chunks(batches, "_text", 1 << 19):
            found = [f.astype(np.int32) for f in features(texts)]
            ends = pa.array(np.cumsum([0] + [len(f) for f in found], dtype=np.int32))
            lists = pa.ListArray.from_arrays(ends, pa.array(np.concatenate(found) if found else np.empty(0, np.int32), pa.int32()))
            yield pa.RecordBatch.from_arrays([column(part, "_id"), column(part, "_label"), lists], names=["_id", "_label", "f"])

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if held := [b for b in batches if b.num_rows]:
            got = pa.Table.from_batches(held).sort_by("_id")
            model = fit([x.values.to_numpy() for x in got.column("f")], got.column("_label").to_numpy().astype(np.int64))
            yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(model)], pa.binary())], names=["model"])

    kind = sample.schema["_id"].dataType.simpleString()
    made = sample.mapInArrow(run, f"_id {kind}, _label int, f array<int>")
    rows = made.repartition(1).mapInArrow(learn, "model binary").collect()
    return pickle.loads(rows[0]["model"]) if rows else fit([], np.empty(0, np.int64))
