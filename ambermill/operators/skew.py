"""Hot keys, salting and two-phase aggregation.

Spark's partial/final aggregation combines on the map side already; salting is for work that
can't be combined there, and is kept as an explicit operator.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ambermill.functions.columns import fresh_names

def hot_key_counts(df: DataFrame, key: str, threshold: int, sample_fraction: float = 1.0, seed: int = 42) -> DataFrame:
    """Keys whose (estimated) count reaches the threshold: columns key, est_count."""
    if not 0 < sample_fraction <= 1:
        raise ValueError(f"sample_fraction must lie in (0, 1], got {sample_fraction}")
    part = df.select(key)
    if sample_fraction < 1:
        part = part.sample(False, sample_fraction, seed)
    counts = part.groupBy(key).agg((F.count(F.lit(1)) / F.lit(sample_fraction)).cast("long").alias("est_count"))
    return counts.where(F.col("est_count") >= threshold)


MOST_HOT_KEYS = 10_000
KEY_BYTES, BROADCAST_BYTES = 64, 24 << 20


def detect_hot_keys(df: DataFrame, key: str, threshold: int, sample_fraction: float = 1.0, seed: int = 42, most: int = MOST_HOT_KEYS) -> list:
    """The hot keys themselves. They become part of a plan, so more than `most` of them are an error: the threshold is too low."""
    found = [r[0] for r in hot_key_counts(df, key, threshold, sample_fraction, seed).select(key).limit(most + 1).collect()]
    if len(found) > most:
        raise ValueError(f"more than {most} keys have {threshold} rows; raise the threshold")
    return found


def find_hot_keys(df: DataFrame, key: str, threshold: int, sample_fraction: float = 1.0, seed: int = 42, most: int = MOST_HOT_KEYS) -> list | DataFrame:
    """All hot keys, however many, as add_salt takes them: a list of up to `most`, and beyond that a table, marked for broadcast if its counted rows are few enough."""
    found = hot_key_counts(df, key, threshold, sample_fraction, seed).select(key)
    first = [r[0] for r in found.limit(most + 1).collect()]
    if len(first) <= most:
        return first
    return F.broadcast(found) if found.count() * KEY_BYTES <= BROADCAST_BYTES else found


def add_salt(df: DataFrame, hot_col: str, hot_keys: Sequence | DataFrame, buckets: int, seed: int = 42) -> DataFrame:
    """_salt: 0..buckets-1 for hot keys, 0 for the rest (NULL keys too). hot_keys: the keys, or a table of one column that has each of them once.

    The salt comes from a hash of the row, so a retried task deals its rows out as before. Rows equal in all columns share a salt.
    """
    if buckets < 1:
        raise ValueError(f"buckets must be 1 or more, got {buckets}")
    dealt = F.pmod(F.xxhash64(F.lit(seed), *[F.col(f"`{c}`") for c in df.columns]), F.lit(buckets)).cast("int")
    if isinstance(hot_keys, DataFrame):
        (name,) = fresh_names(df.columns, "_hot")
        named = df.join(hot_keys.toDF(name), F.col(f"`{hot_col}`") == F.col(name), "left")
        return named.withColumn("_salt", F.when(F.col(name).isNotNull(), dealt).otherwise(F.lit(0))).drop(name)
    hot = F.col(hot_col).isin(list(hot_keys)) if hot_keys else F.lit(False)
    return df.withColumn("_salt", F.when(hot, dealt).otherwise(F.lit(0)))


def salted_repartition(df: DataFrame, key: str, hot_keys: Sequence | DataFrame, partitions: int, buckets: int = 16) -> DataFrame:
    """All rows dealt by (key, salt): the rows of a hot key come to as many partitions as it has salts; a second repartition by key
    would bring them together again. The columns stay."""
    return add_salt(df, key, hot_keys, buckets).repartition(partitions, key, "_salt").drop("_salt")


def salted_aggregate(
    df: DataFrame, group_cols: Sequence[str], hot_col: str, hot_keys: Sequence | DataFrame, salt_buckets: int, aggregates: Sequence[tuple[str, str]], seed: int = 42
) -> DataFrame:
    """Aggregate by (group, salt), then by group. aggregates: (column, "count" | "sum" | "avg"), named {column}_{op}.

    count takes rows and ignores the column. Sums of floating-point columns may differ in the last digits from
    those of one pass.
    """
    bad = {op for _, op in aggregates} - {"count", "sum", "avg"}
    if bad:
        raise ValueError(f"unknown aggregate {sorted(bad)}; choose count, sum or avg")
    first: dict[str, Column] = {}
    last: list[Column] = []
    for col, op in aggregates:
        if op == "count":
            first["_n"] = F.count(F.lit(1))
            last.append(F.sum("_n").alias(f"{col}_count"))
        else:
            first[f"_s_{col}"] = F.sum(col)
            first[f"_c_{col}"] = F.count(col)
            s, n = F.sum(f"_s_{col}"), F.sum(f"_c_{col}")
            last.append((s if op == "sum" else F.try_divide(s, n)).alias(f"{col}_{op}"))
    salted = add_salt(df, hot_col, hot_keys, salt_buckets, seed)
    partial = salted.groupBy(*group_cols, "_salt").agg(*[c.alias(n) for n, c in first.items()])
    return partial.groupBy(*group_cols).agg(*last)
