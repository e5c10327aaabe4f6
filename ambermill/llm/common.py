"""Shared pieces: stored intermediates, Arrow chunks, connected components, star linking."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ambermill.session import checkpoint_root

CHUNK_BYTES = 2 << 20
_HELD: ContextVar[list[str] | None] = ContextVar("stored by a scratch block", default=None)
BROADCAST_BYTES = 24 << 20
TWO_LEVELS = "spark.sql.codegen.aggregate.map.twolevel.enabled"


def stash(df: DataFrame, name: str = "t", **options: str) -> DataFrame:
    """Write to the shared folder and read back: cuts the lineage, survives lost executors, and gives the planner real sizes."""
    path = f"{checkpoint_root(df.sparkSession).rstrip('/')}/ambermill/{uuid.uuid4().hex}/{name}"
    df.write.options(compression="snappy", **options).parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._stashed_at = path
    if (held := _HELD.get()) is not None:
        held.append(path)
    return out


def stash_plain(df: DataFrame, name: str = "t") -> DataFrame:
    """stash() without Parquet's dictionaries: to look up each value in one is in vain for hashes and texts."""
    return stash(df, name, **{"parquet.enable.dictionary": "false"})


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Delete at the end whatever was stored inside and is still there. Results must be written by then."""
    mark = _HELD.set([])
    try:
        yield
    finally:
        for path in _HELD.get():
            delete_folder(spark, path.rpartition("/")[0])
        _HELD.reset(mark)


@contextmanager
def one_level_maps(spark: SparkSession) -> Iterator[None]:
    """Aggregate without the map of 65,536 groups that Spark puts before its hash table, for what runs inside. With nearly as many groups as rows
    it is soon full, and then each row looks in both. A setting of the session's own stays."""
    if spark.conf.get(TWO_LEVELS, None) not in (None, "true"):
        yield
        return
    had = TWO_LEVELS in {r.key for r in spark.sql("SET").collect()}
    spark.conf.set(TWO_LEVELS, "false")
    try:
        yield
    finally:
        spark.conf.set(TWO_LEVELS, "true") if had else spark.conf.unset(TWO_LEVELS)


def unstash(*stored: DataFrame) -> None:
    """Delete what stash() wrote, once nothing that is still to run reads it."""
    for df in stored:
        delete_folder(df.sparkSession, df._stashed_at.rpartition("/")[0])


def delete_folder(spark: SparkSession, path: str) -> None:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def small(df: DataFrame, row_bytes: int) -> DataFrame:
    """A stored table, marked for broadcast only if its counted rows come to no more than BROADCAST_BYTES; else joins shuffle, and hot keys are split."""
    return F.broadcast(df) if df.count() * row_bytes <= BROADCAST_BYTES else df


def chunks(batches: Iterator[pa.RecordBatch], text: str, most: int = CHUNK_BYTES) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """Slices of the batches with about `most` bytes of text, and their texts (NULL as empty). A longer text comes alone."""
    for batch in batches:
        col = batch.column(batch.schema.get_field_index(text))
        sizes = pc.fill_null(pc.binary_length(col), 0).to_pylist()
        at = size = 0
        for i, n in enumerate(sizes):
            if i > at and size + n > most:
                part = batch.slice(at, i - at)
                yield part, [t or "" for t in col.slice(at, i - at).to_pylist()]
                at, size = i, 0
            size += n
        if at < len(sizes):
            yield batch.slice(at), [t or "" for t in col.slice(at).to_pylist()]


def column(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))


def _stars(e: DataFrame) -> bool:
    """Whether (u, v) edges are stars: one v for each u, and no v is a u. One aggregate by node, which a hub's edges reach summed up."""
    ends = F.explode(F.array(F.struct(F.col("u").alias("node"), F.lit(1).alias("up")), F.struct(F.col("v").alias("node"), F.lit(0).alias("up"))))
    per = e.select(ends.alias("end")).select("end.*").groupBy("node").agg(F.sum("up").alias("ups"), F.min("up").alias("least"))
    return per.where("ups > 1 or (ups = 1 and least = 0)").isEmpty()


def components(edges: DataFrame, a: str = "a", b: str = "b", rounds: int = 60) -> DataFrame:
    """Distributed union-find by alternating large-star and small-star steps: (node, root) for every node that is not
    the least of its component. Only edges are moved; nothing but two emptiness tests reaches the driver."""
    e = edges.where(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct()
    e = stash(e, "edges")
    for _ in range(rounds):
        if _stars(e):
            return e.select(F.col("u").alias("node"), F.col("v").alias("root"))  # still stored
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        # minima are stored: a join with them is then small enough to broadcast, or has a hub's edges split among tasks
        low = stash(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "low")
        large = stash(both.join(small(low, 16), "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct(), "large")
        least = stash(large.groupBy("u").agg(F.min("v").alias("m")), "least")
        joined = large.join(small(least, 16), "u")
        hung = joined.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v")))
        last, e = e, stash(hung.distinct(), "edges")
        unstash(last, low, large, least)
    raise RuntimeError(f"components did not settle in {rounds} rounds")


def open_lists(lists: DataFrame, roots: DataFrame | None) -> DataFrame:
    """The lists (key, id, further columns) that hold several components, with root and grown (whether the component has several ids); stored."""
    out = lists.withColumn("root", F.col("id")).withColumn("grown", F.lit(False))
    if roots is not None:
        known = stash(roots.unionByName(roots.select(F.col("root").alias("node"), "root").distinct()), "known")
        out = lists.join(small(known, 16).withColumnRenamed("node", "id"), "id", "left")
        out = out.withColumn("grown", F.col("root").isNotNull()).withColumn("root", F.coalesce("root", "id"))
    split = stash(out.groupBy("key").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo <> hi").select("key"), "split")
    out = stash(out.join(small(split, 8), "key", "left_semi").select(*lists.columns, "root", "grown"), "open")
    unstash(split)
    return out
