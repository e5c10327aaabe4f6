"""Trailing RANGE windows over whole seconds.

All windows of a group go into ONE select: Catalyst then plans one Exchange,
one Sort and one Window node whatever the number of frames.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from ambermill.functions.columns import fresh_names


@dataclass(frozen=True)
class TrailingFrame:
    """Rows whose second lies in [t + start, t + end]; strict frames end at or before -1."""

    name: str
    start: int
    end: int

    def __post_init__(self) -> None:
        if self.start > self.end:
            raise ValueError(f"frame {self.name}: start {self.start} lies after end {self.end}")


@dataclass(frozen=True)
class FeatureAgg:
    prefix: str
    fn: str
    col: str


# count takes rows, whatever the column holds; avg skips NULLs and is NULL over none.
AGGREGATES = {
    "count": lambda c: F.count(F.lit(1)),
    "avg": lambda c: F.avg(c),
    "sum": lambda c: F.sum(c),
    "min": lambda c: F.min(c),
    "max": lambda c: F.max(c),
}


def trailing_window(keys: Sequence[str], seconds_col: str, start: int, end: int) -> WindowSpec:
    return Window.partitionBy(*keys).orderBy(F.col(seconds_col)).rangeBetween(start, end)


def trailing_columns(keys: Sequence[str], seconds_col: str, frames: Sequence[TrailingFrame], aggs: Sequence[FeatureAgg]) -> list[Column]:
    unknown = {a.fn for a in aggs} - AGGREGATES.keys()
    if unknown:
        raise KeyError(f"unknown aggregate {sorted(unknown)}; choose one of {sorted(AGGREGATES)}")
    return [
        AGGREGATES[a.fn](F.col(a.col)).over(trailing_window(keys, seconds_col, f.start, f.end)).alias(f"{a.prefix}_{f.name}")
        for a in aggs
        for f in frames
    ]


def add_trailing_windows(df: DataFrame, keys: Sequence[str], seconds_col: str, frames: Sequence[TrailingFrame], aggs: Sequence[FeatureAgg]) -> DataFrame:
    return df.select("*", *trailing_columns(keys, seconds_col, frames, aggs))


def add_sliced_trailing_windows(
    df: DataFrame, keys: Sequence[str], seconds_col: str, frames: Sequence[TrailingFrame], aggs: Sequence[FeatureAgg], slice_seconds: int
) -> DataFrame:
    """The same columns for hot keys: each key is cut into time slices, and each slice
    also gets the rows that its frames reach back to. A key's window work then spreads over
    as many tasks as it has slices; every row is copied 1 + ceil(reach / slice) times at most.
    Frames must lie in the past (end <= 0). Rows without a second get the plain window's values
    of an all-NULL peer group, as they form a slice of their own.
    """
    if slice_seconds < 1:
        raise ValueError("slice_seconds must be positive")
    if any(f.end > 0 for f in frames):
        raise ValueError("sliced windows look back only")
    reach = max(-f.start for f in frames)
    copies = -(-reach // slice_seconds)
    own = F.floor(F.col(seconds_col) / F.lit(slice_seconds)).cast("long")
    own_, ahead, cut = fresh_names(df.columns, "_own", "_ahead", "_slice")
    dealt = (
        df.withColumn(own_, own)
        .withColumn(ahead, F.explode(F.when(F.col(own_).isNull(), F.array(F.lit(0))).otherwise(F.sequence(F.lit(0), F.lit(copies)))))
        .withColumn(cut, F.col(own_) + F.col(ahead))
    )
    out = dealt.select("*", *trailing_columns([*keys, cut], seconds_col, frames, aggs))
    return out.where(F.col(ahead) == 0).drop(cut, own_, ahead)
