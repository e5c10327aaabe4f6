"""Projections: name normalisation, casts, derived columns, ratios, time grains.

Everything here is a single select of built-in expressions, so it stays inside
whole-stage code generation and lets filters and pruning reach the scan.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Explicit names and types of the trip schema.
RENAMES = {
    "VendorID": "vendor_id",
    "tpep_pickup_datetime": "pickup_datetime",
    "tpep_dropoff_datetime": "dropoff_datetime",
    "RatecodeID": "rate_code_id",
    "PULocationID": "pu_location_id",
    "DOLocationID": "do_location_id",
}
TRIP_TYPES = {
    **dict.fromkeys(("vendor_id", "passenger_count", "rate_code_id", "pu_location_id", "do_location_id", "payment_type"), "long"),
    **dict.fromkeys(("pickup_datetime", "dropoff_datetime"), "timestamp"),
    **dict.fromkeys(
        (
            "trip_distance", "fare_amount", "extra", "mta_tax", "tip_amount", "tolls_amount",
            "improvement_surcharge", "total_amount", "congestion_surcharge", "airport_fee",
        ),
        "double",
    ),
    "store_and_fwd_flag": "string",
}


def snake_case(name: str) -> str:
    """Split where a lower-case letter or digit meets a capital; squeeze and strip underscores."""
    spaced = re.sub(r"([a-z0-9])([A-Z])", r"\1_\2", name)
    return re.sub(r"_+", "_", spaced).strip("_").lower()


def normalized_names(names: Iterable[str], renames: Mapping[str, str] = RENAMES) -> list[str]:
    """Target name of each column; a name that would collide keeps its old form."""
    names = list(names)
    taken = set(names)
    out = []
    for name in names:
        new = renames.get(name)
        if new is None or new in taken:
            new = snake_case(name)
        if new != name and new in taken:
            new = name
        taken.add(new)
        out.append(new)
    return out


def fresh_names(taken: Iterable[str], *names: str) -> list[str]:
    """Column names like the given ones that aren't taken (case plays no part)."""
    used = {c.lower() for c in taken}
    return [next(c for c in (n + "_" * i for i in range(len(used) + 1)) if c.lower() not in used) for n in names]


def normalize_columns(df: DataFrame, renames: Mapping[str, str] = RENAMES) -> DataFrame:
    return df.toDF(*normalized_names(df.columns, renames))


def cast_columns(df: DataFrame, types: Mapping[str, str] = TRIP_TYPES) -> DataFrame:
    """Cast the known columns that are present. Values that don't parse become NULL, under ANSI mode too."""
    return df.select([F.col(f"`{c}`").try_cast(types[c]).alias(c) if c in types else F.col(f"`{c}`") for c in df.columns])


def add_derived_columns(df: DataFrame, ts_col: str = "pickup_datetime") -> DataFrame:
    return df.withColumns({"ingest_ts": F.current_timestamp(), "event_date": F.to_date(ts_col)})


def ratio_clip(num: Column, den: Column, lo: float = 0.0, hi: float = 1.0) -> Column:
    """num / den limited to [lo, hi]; NULL where den <= 0 or either is NULL."""
    r = F.when(den > 0, F.try_divide(num, den))
    return F.when(r.isNull(), None).when(r < lo, F.lit(lo)).when(r > hi, F.lit(hi)).otherwise(r)


def add_tip_pct(df: DataFrame) -> DataFrame:
    return df.withColumn("tip_pct", ratio_clip(F.col("tip_amount"), F.col("fare_amount")))


def epoch_seconds(ts: Column | str) -> Column:
    """Whole UTC seconds of a timestamp or date (a date counts as its midnight)."""
    return F.unix_timestamp(ts)


def day_start(date: Column | str) -> Column:
    return F.col(date).cast("timestamp") if isinstance(date, str) else date.cast("timestamp")


def hour_of_day(ts: Column | str) -> Column:
    return F.hour(ts).cast("double")


def zoned_timestamps(df: DataFrame) -> DataFrame:
    """Timestamps without a zone, read as the session's zone (UTC)."""
    plain = {f.name for f in df.schema.fields if isinstance(f.dataType, T.TimestampNTZType)}
    return df.select([F.col(f"`{c}`").cast("timestamp").alias(c) if c in plain else F.col(f"`{c}`") for c in df.columns])


def run_key(group: str, code_version: str, paths: Iterable[str], fingerprint: str = "") -> str:
    """First 32 hex digits of sha256(group, version, sorted paths, input fingerprint), joined without separators."""
    text = group + code_version + "".join(sorted(paths)) + fingerprint
    return hashlib.sha256(text.encode()).hexdigest()[:32]


def run_key_column(group: Column, code_version: Column, paths: Column) -> Column:
    """run_key for tables of runs; paths is an array column."""
    return F.substring(F.sha2(F.concat(group, code_version, F.array_join(F.array_sort(paths), "")), 256), 1, 32)
