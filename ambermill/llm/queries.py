"""One query for each operator, over whole tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ambermill.llm.bpe_automaton import encode_documents
from ambermill.llm.fingerprints import fingerprint_documents
from ambermill.llm.line_dedup import dedup_lines
from ambermill.llm.ngram_join import similar_documents
from ambermill.llm.packing import pack_documents
from ambermill.llm.quality import THRESHOLD as GOOD
from ambermill.llm.quality import score_quality, train_quality
from ambermill.llm.sampling import fold
from ambermill.llm.sharding import shard_documents
from ambermill.llm.token_counts import count_tokens
from ambermill.llm.toxicity import THRESHOLD as TOXIC
from ambermill.llm.toxicity import score_toxicity, train_toxicity
from ambermill.llm.vector_search import nearest


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return df.select(*columns) if columns else df


def texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents", "doc_id", "text")


def op1_line_dedup(spark, sf_dir):
    """Every line that isn't blank: its component, and whether it stays."""
    return dedup_lines(texts(spark, sf_dir)).drop("text_hash")


def op2_ngram_jaccard(spark, sf_dir):
    return similar_documents(texts(spark, sf_dir), width=4, percent=85).select("doc_id", "n_shingles", "component_id")


def op3_fingerprints(spark, sf_dir):
    made = fingerprint_documents(texts(spark, sf_dir)).withColumn("edited_sha256", F.sha2("edited", 256))
    return made.select("doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next")


def op4_sharding(spark, sf_dir):
    placed = shard_documents(texts(spark, sf_dir), 40)
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), F.col("vslot").alias("virtual_slot"))


def op5_bpe_automaton(spark, sf_dir):
    made = encode_documents(texts(spark, sf_dir), decoded=True)
    return made.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(F.array_join("ids", ","), 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op6_token_counts(spark, sf_dir):
    return count_tokens(texts(spark, sf_dir)).withColumn("over_limit", F.col("n_tokens") > 1024)


def op7_toxicity(spark, sf_dir):
    docs, held = texts(spark, sf_dir), fold(F.col("doc_id"), 4) == 2
    model = train_toxicity(docs, table(spark, sf_dir, "labels", "doc_id", "toxic"), ~held)
    scored = score_toxicity(docs, model)
    return scored.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= TOXIC).cast("int").alias("predicted"))


def op8_quality(spark, sf_dir):
    docs, held = texts(spark, sf_dir), fold(F.col("doc_id"), 3) == 1
    model = train_quality(docs, table(spark, sf_dir, "labels", "doc_id", "quality"), ~held)
    scored = score_quality(docs, model)
    return scored.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= GOOD).cast("int").alias("predicted"))


def op9_multi_index(spark, sf_dir):
    return nearest(table(spark, sf_dir, "embeddings", "vec_id", "embedding"), F.col("vec_id") % 20 == 0)


def op10_packing(spark, sf_dir):
    return pack_documents(texts(spark, sf_dir))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = [op1_line_dedup, op2_ngram_jaccard, op3_fingerprints, op4_sharding, op5_bpe_automaton, op6_token_counts, op7_toxicity, op8_quality, op9_multi_index, op10_packing]
    return {f.__name__: f for f in found}


def oracle_sql() -> dict[str, str]:
    return {}
