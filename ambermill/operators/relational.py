"""Small relational helpers: latest per group, deterministic dedup, top-1."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_per_group(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row a group, the first by order. Spark prunes each task to one row a group before it shuffles."""
    if "_rn" in df.columns:
        raise ValueError("column _rn is reserved")
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1).drop("_rn")


def dedup_keep_latest(df: DataFrame, keys: Sequence[str], ts_col: str, tiebreak: Sequence[str]) -> DataFrame:
    return first_per_group(df, keys, [F.col(ts_col).desc_nulls_last(), *[F.col(c).desc_nulls_last() for c in tiebreak]])


def column_means(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.agg(*[F.avg(c).alias(f"{c}_mean") for c in cols])
