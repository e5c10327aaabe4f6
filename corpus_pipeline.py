"""Corpus pipeline: toxicity, quality, line dedup, n-gram Jaccard join, packing.

Every stage takes all rows that the stage before kept and returns the columns it got (packing: pieces). Whatever the columns of docs are called,
and whichever of their values are NULL, nothing crashes; an empty table gives an empty one. Whoever writes a stage's result, its row groups and
batches are small (session.TASK_MEMORY, unless the session sets its own), so that the next stage fits a small heap, however many rows there are.
"""

from __future__ import annotations

import functools
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ambermill.functions.columns import fresh_names
from ambermill.llm.common import delete_folder, scratch, small, stash
from ambermill.llm.line_dedup import drop_duplicate_lines
from ambermill.llm.ngram_join import row_key, similar_documents
from ambermill.llm.packing import pack_documents
from ambermill.llm.quality import THRESHOLD as GOOD
from ambermill.llm.quality import score_quality, train_quality
from ambermill.llm.toxicity import THRESHOLD as TOXIC
from ambermill.llm.toxicity import score_toxicity, train_toxicity
from ambermill.session import bound_task_memory, checkpoint_root


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bounded(stage: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    @functools.wraps(stage)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        bound_task_memory(spark)
        return stage(spark, docs, sf_dir)

    return run_stage


@bounded
def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored below the toxicity threshold. The model learns from the labelled documents of the corpus.

    A row is scored by its own text: repeated rows stay or go together; NULL and empty texts get the score of no features; ids play no part.
    """
    (score,) = fresh_names(docs.columns, "_toxicity")
    model = train_toxicity(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))
    return score_toxicity(docs, model, score=score).where(F.col(score) < TOXIC).drop(score)


@bounded
def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored at or above the quality threshold. NULL and empty texts, repeated rows and ids are treated as in toxicity()."""
    (score,) = fresh_names(docs.columns, "_quality")
    model = train_quality(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))
    return score_quality(docs, model, score=score).where(F.col(score) >= GOOD).drop(score)


@bounded
def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that repeat, or nearly repeat, an earlier one; n_chars follows where there is one.

    All rows stay: a document whose lines are all repeats keeps an empty text, a NULL text stays NULL. "Earlier" goes by doc_id (NULL first), then by
    the hash of the text and by line; rows equal in id and text are one document, whose lines stay or go together.
    """
    out = drop_duplicate_lines(docs)
    return out.withColumn("n_chars", F.char_length("text").cast("long")) if "n_chars" in docs.columns else out


@bounded
def ngram_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group linked by five-word shingles at 0.8: that of least id, rows without an id coming last. Of rows that repeat
    its id and text too, the least stays. Rows without words are linked with nothing and stay."""
    key, gone, row = fresh_names(docs.columns, "_k", "_gone", "_row")
    found = similar_documents(docs, width=5, percent=80).where("root is not null")
    rows = stash(found.groupBy("root", "k").agg(F.min("doc_id").alias("doc_id"), F.count(F.lit(1)).alias("copies")), "rows")
    firsts = rows.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "k"))["k"].alias("first"), F.sum("copies").alias("n"))
    firsts = stash(firsts.where("n > 1").select("root", "first"), "firsts")
    marked = rows.join(small(firsts, 16), "root").where("k <> first or copies > 1").select(F.col("k").alias(key), (F.col("k") != F.col("first")).alias(gone))
    marked = stash(marked, "marked")
    named = docs.withColumn(key, row_key("doc_id", "text")).join(small(marked, 16), key, "left")
    single = named.where(F.col(gone).isNull()).select(*[F.col(f"`{c}`") for c in docs.columns])
    if marked.where(~F.col(gone)).isEmpty():
        return single
    kept = named.where(~F.col(gone)).groupBy(key).agg(F.min(F.struct(*[F.col(f"`{c}`") for c in docs.columns])).alias(row))
    return single.unionByName(kept.select(f"{row}.*"))


@bounded
def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of at most 1024 tokens. Every row is packed, repeated ones too; a NULL or empty text is one token."""
    return pack_documents(docs)


STAGES = [("toxicity", toxicity), ("quality", quality), ("line_dedup", line_dedup), ("ngram_join", ngram_join), ("packing", packing)]

# Trained models and tokenizers have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written as Parquet to the shared folder and reread by the next. What a stage stored
    for itself, and what it read, is deleted once it is written; the last stage reads the one before, which stays."""
    root = f"{checkpoint_root(spark).rstrip('/')}/ambermill/{uuid.uuid4().hex}"
    docs = _table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES[:-1]):
        with scratch(spark):
            stage(spark, docs, sf_dir).write.parquet(f"{root}/{name}")
        if i:
            delete_folder(spark, f"{root}/{STAGES[i - 1][0]}")
        docs = spark.read.parquet(f"{root}/{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
