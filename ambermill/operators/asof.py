"""Backward as-of join, left outer, with a tolerance in whole seconds."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ambermill.functions.columns import fresh_names

MOST_OFFERS = 4_096


def _check(spine: DataFrame, features: DataFrame, ts_col: str, keys: Sequence[str], tolerance: int) -> None:
    if tolerance < 0:
        raise ValueError(f"tolerance must be 0 or more, got {tolerance}")
    for side, df in (("spine", spine), ("features", features)):
        missing = [c for c in (*keys, ts_col) if c not in df.columns]
        if missing:
            raise ValueError(f"{side} lacks column(s) {missing}")


def _payload(spine: DataFrame, features: DataFrame, ts_col: str, keys: Sequence[str], prefix: str) -> dict[str, str]:
    """Feature column -> output column; the time column and names the spine has get the prefix."""
    out = {ts_col: f"{prefix}_{ts_col}"}
    for c in features.columns:
        if c not in (*keys, ts_col):
            out[c] = f"{prefix}_{c}" if c in spine.columns else c
    clash = [n for n in out.values() if n in spine.columns]
    if clash or len(set(out.values())) < len(out):
        raise ValueError(f"prefix {prefix!r} doesn't make names unique: {sorted(clash) or sorted(out.values())}")
    return out


def _latest(features: DataFrame, ts_col: str, keys: Sequence[str], names: dict[str, str]) -> DataFrame:
    """One row for each key and time. Among rows that tie, the greatest by value stays."""
    rest = [c for c in names if c != ts_col]
    usable = features.where(F.col(ts_col).isNotNull()).dropna(subset=list(keys))
    if not rest:
        return usable.select(*keys, ts_col).distinct()
    values = F.struct(*[F.col(c) for c in rest])
    picked = usable.groupBy(*keys, ts_col).agg(F.max(values).alias("_v"))
    return picked.select(*keys, ts_col, *[F.col(f"_v.`{c}`").alias(c) for c in rest])


def as_of_join(
    spine: DataFrame, features: DataFrame, ts_col: str, keys: Sequence[str], tolerance: int, prefix: str = "asof", small_features: bool = False, slice_seconds: int | None = None
) -> DataFrame:
    """Give each spine row the latest feature row at or before it, if it is at most `tolerance` whole seconds older.

    Spine rows are kept as they are, duplicates included; without a match, with a NULL key or a
    NULL time, the feature columns are NULL. Features are first reduced to one row a key and time (a shuffle of the feature side alone);
    then both sides are united (features before spine rows of the same time), shuffled and sorted by key, and the last feature is
    carried forward. The most recent feature is valid if any is, so one look back is enough.

    small_features=True is for a feature side with few rows a key and tolerance (days x a few keys): it becomes an equi-join on key and
    bucket that AQE may broadcast after it has measured it, and no hot key is sorted. Where a bucket holds more than MOST_OFFERS rows, the plan above is used.
    slice_seconds cuts hot keys into time slices of that width, each a group of its own: the last feature of a slice is offered
    to the 1 + ceil(tolerance / slice) slices after it, which is all that a later slice can use of it.
    """
    _check(spine, features, ts_col, keys, tolerance)
    names = _payload(spine, features, ts_col, keys, prefix)
    feats = _latest(features, ts_col, keys, names)
    if slice_seconds is not None and slice_seconds < 1:
        raise ValueError(f"slice_seconds must be positive, got {slice_seconds}")
    if small_features and _fullest_bucket(feats, ts_col, keys, tolerance) <= MOST_OFFERS:
        return _bucketed(spine, feats, ts_col, keys, tolerance, names)
    side, feature, seen_, cut = fresh_names(spine.columns, "_side", "_feature", "_seen", "_slice")
    value = F.struct(*[F.col(c).alias(n) for c, n in names.items()])
    kept = [c for c in spine.columns if c not in (*keys, ts_col)]
    own = F.floor(F.unix_timestamp(ts_col) / F.lit(slice_seconds)).cast("long") if slice_seconds else F.lit(0).cast("long")
    left = spine.select(*keys, ts_col, own.alias(cut), F.lit(1).alias(side), *kept)
    right = feats.select(*keys, ts_col, own.alias(cut), F.lit(0).alias(side), value.alias(feature))
    if slice_seconds:
        lasts = right.groupBy(*keys, cut).agg(F.max(F.struct(ts_col, feature)).alias("_last"))
        later = F.explode(F.sequence(F.col(cut) + 1, F.col(cut) + 1 + -(-tolerance // slice_seconds)))
        right = right.unionByName(lasts.select(*keys, F.col(f"_last.`{ts_col}`").alias(ts_col), later.alias(cut), F.lit(0).alias(side), F.col(f"_last.`{feature}`").alias(feature)))
    both = left.unionByName(right, allowMissingColumns=True)
    w = Window.partitionBy(*keys, cut).orderBy(F.col(ts_col).asc_nulls_first(), side).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    seen = both.withColumn(seen_, F.last(feature, ignorenulls=True).over(w)).where(F.col(side) == 1)
    age = F.unix_timestamp(ts_col) - F.unix_timestamp(F.col(f"{seen_}.`{names[ts_col]}`"))
    ok = (age <= tolerance) & F.col(ts_col).isNotNull()
    for k in keys:
        ok = ok & F.col(k).isNotNull()
    return seen.select(*spine.columns, *[F.when(ok, F.col(f"{seen_}.`{n}`")).alias(n) for n in names.values()])


def _bucket(ts_col: str, tolerance: int) -> Column:
    return F.floor(F.unix_timestamp(ts_col) / F.lit(tolerance + 1)).cast("long")


def _fullest_bucket(feats: DataFrame, ts_col: str, keys: Sequence[str], tolerance: int) -> int:
    counts = feats.groupBy(*keys, _bucket(ts_col, tolerance).alias("_b")).agg(F.count(F.lit(1)).alias("_n"))
    return counts.agg(F.max("_n")).first()[0] or 0


def _bucketed(spine: DataFrame, feats: DataFrame, ts_col: str, keys: Sequence[str], tolerance: int, names: dict[str, str]) -> DataFrame:
    """Equi-join on key and bucket of width tolerance+1. A feature can serve its own bucket and the next,
    so it (the small side) is written twice; each bucket then keeps, for a spine row, the latest valid one."""
    own = _bucket(ts_col, tolerance)
    temporary = fresh_names([*spine.columns, *names, *names.values()], "_b", "_offers", "_best", *[f"_k{i}" for i in range(len(keys))])
    b_, offers_, best_, *ks = temporary
    right = feats.select(
        *[F.col(k).alias(ks[i]) for i, k in enumerate(keys)],
        F.explode(F.array(own, own + 1)).alias(b_),
        F.struct(F.col(ts_col).alias("_t"), F.struct(*[F.col(c).alias(n) for c, n in names.items()]).alias("_v")).alias("_f"),
    )
    offers = right.groupBy(*ks, b_).agg(F.array_sort(F.collect_list("_f")).alias(offers_))
    cond = own == F.col(b_)
    for i, k in enumerate(keys):
        cond = cond & (F.col(k) == F.col(ks[i]))
    joined = spine.join(offers, cond, "left")
    fits = F.filter(offers_, lambda f: (f["_t"] <= F.col(ts_col)) & (F.unix_timestamp(ts_col) - F.unix_timestamp(f["_t"]) <= tolerance))
    best = F.try_element_at(fits, F.lit(-1))["_v"]
    return joined.withColumn(best_, best).select(*spine.columns, *[F.col(f"{best_}.`{n}`").alias(n) for n in names.values()])
