"""Feature groups as DataFrame plans."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ambermill.functions.columns import add_tip_pct, day_start, epoch_seconds
from ambermill.operators.asof import as_of_join
from ambermill.operators.windows import TrailingFrame, add_sliced_trailing_windows, trailing_columns
from ambermill.plans.specs import FeatureSpec

# Columns of the trip spine.
SPINE_COLUMNS = (
    "vendor_id", "pu_location_id", "pickup_datetime", "dropoff_datetime", "passenger_count", "trip_distance",
    "payment_type", "fare_amount", "tip_amount", "event_date",
)


HOT_ROWS = 20_000_000  # rows of a key that one task should not sort
SLICES_A_REACH = 2


def event_grain_features(bronze: DataFrame, spec: FeatureSpec, hot_rows: int | None = None) -> DataFrame:
    """One row an event with a key and a time: keys, time, date and all window columns. Scan, Exchange by key, Sort, Window.

    With hot_rows, keys are counted first; where one has so many rows, keys are cut into time slices as wide as half the longest frame.
    """
    values = {a.col for a in spec.aggs if a.fn != "count"}
    base = [*spec.entity_key, spec.event_ts_col, spec.event_date_col]
    rows = bronze.select(*base, *sorted(values - set(base))).dropna(subset=[*spec.entity_key, spec.event_ts_col])
    rows = rows.withColumn("_u", epoch_seconds(spec.event_ts_col))
    aggs = [type(a)(a.prefix, a.fn, "_u" if a.fn == "count" else a.col) for a in spec.aggs]
    if hot_rows and not rows.groupBy(*spec.entity_key).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") >= hot_rows).isEmpty():
        width = max(1, max(-f.start for f in spec.frames) // SLICES_A_REACH)
        rows = add_sliced_trailing_windows(rows, spec.entity_key, "_u", spec.frames, aggs, width)
        return rows.select(*base, *[f"{a.prefix}_{f.name}" for a in aggs for f in spec.frames])
    return rows.select(*base, *trailing_columns(spec.entity_key, "_u", spec.frames, aggs))


def daily_partials(rows: DataFrame, keys: Sequence[str], date_col: str, values: Sequence[str]) -> DataFrame:
    """Row count, and count and sum of each value, by key and day: _n, _c_<v>, _s_<v>."""
    aggs = [F.count(F.lit(1)).alias("_n")]
    for v in values:
        aggs += [F.count(v).alias(f"_c_{v}"), F.sum(v).alias(f"_s_{v}")]
    return rows.groupBy(*keys, date_col).agg(*aggs)


def windowed_partials(days: DataFrame, keys: Sequence[str], date_col: str, frames: Sequence[TrailingFrame], aggs: Sequence) -> list:
    """Window columns over daily partials: counts add up (0 over no day), means are sums over counts (NULL over none)."""
    cols = []
    for a in aggs:
        for f in frames:
            w = Window.partitionBy(*keys).orderBy("_u").rangeBetween(f.start, f.end)
            if a.fn == "count":
                c = F.coalesce(F.sum("_n").over(w), F.lit(0).cast("long"))
            elif a.fn == "avg":
                c = F.try_divide(F.sum(f"_s_{a.col}").over(w), F.sum(f"_c_{a.col}").over(w))
            else:
                raise KeyError(f"day grain knows count and avg, not {a.fn}")
            cols.append(c.alias(f"{a.prefix}_{f.name}"))
    return cols


def day_grain_features(bronze: DataFrame, spec: FeatureSpec) -> DataFrame:
    """One row a key and day. The rows shrink to daily partials on the map side before anything is shuffled."""
    values = sorted({a.col for a in spec.aggs if a.fn != "count"})
    rows = bronze.dropna(subset=[*spec.entity_key, spec.event_ts_col])
    days = daily_partials(rows, spec.entity_key, spec.event_date_col, values).withColumn("_u", epoch_seconds(F.col(spec.event_date_col)))
    made = windowed_partials(days, spec.entity_key, spec.event_date_col, spec.frames, spec.aggs)
    return days.select(*spec.entity_key, day_start(spec.event_date_col).alias(spec.event_ts_col), spec.event_date_col, *made)


def compute_pickup_zone_demand(bronze: DataFrame, spec: FeatureSpec) -> DataFrame:
    return event_grain_features(bronze, spec, HOT_ROWS)


def compute_driver_trip_history(bronze: DataFrame, spec: FeatureSpec) -> DataFrame:
    return day_grain_features(add_tip_pct(bronze), spec)


def compute_joined_features(spine: DataFrame, groups: Mapping[str, DataFrame], spec: FeatureSpec, small: Sequence[str] = ()) -> DataFrame:
    """The spine with each feature group joined as of its time, in the order of the spec.
    small: groups (day grain) joined through the bucketed form, which AQE may broadcast."""
    out = spine
    for j in spec.joins:
        out = as_of_join(out, groups[j.feature_group], spec.event_ts_col, j.keys, j.tolerance_seconds, j.prefix, j.feature_group in small)
    return out


def compute_trip_features(bronze: DataFrame, zone: DataFrame, driver: DataFrame, spec: FeatureSpec) -> DataFrame:
    spine = add_tip_pct(bronze.select(*SPINE_COLUMNS))
    return compute_joined_features(spine, {"pickup_zone_demand": zone, "driver_trip_history": driver}, spec, small=("driver_trip_history",))
