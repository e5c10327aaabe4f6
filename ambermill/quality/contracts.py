"""Table contracts: a Spark schema whose fields carry their bounds as metadata, checked in one pass."""

from __future__ import annotations

import operator
from collections.abc import Iterator, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ambermill.control import DataQualityError

# What each bound of a field's metadata forbids. NaN lies above every upper bound.
FORBIDS = {"min": operator.lt, "max": operator.gt}
KINDS = {t.typeName(): t for t in (T.BooleanType, T.DateType, T.DoubleType, T.IntegerType, T.LongType, T.StringType, T.TimestampType)}


class TableContract(T.StructType):
    """A named schema with a primary key. Metadata "min" and "max" bound a field's values."""

    def __init__(self, name: str, fields: Sequence[T.StructField], primary_key: Sequence[str] = ()) -> None:
        super().__init__(list(fields))
        self.name, self.primary_key = name, tuple(primary_key)


def column(name: str, kind: str, low: float | None = None, high: float | None = None, nullable: bool = True) -> T.StructField:
    """A field of a contract; kind is the name of a type in KINDS."""
    if kind not in KINDS:
        raise ValueError(f"{name}: unknown type {kind!r}; choose one of {sorted(KINDS)}")
    bounds = {k: v for k, v in (("min", low), ("max", high)) if v is not None}
    return T.StructField(name, KINDS[kind](), nullable, bounds)


_c = column

# The contracts of the trip tables.
CONTRACTS = {
    "trips": TableContract(
        "trips",
        (
            _c("vendor_id", "long"),
            _c("pickup_datetime", "timestamp", nullable=False),
            _c("dropoff_datetime", "timestamp"),
            _c("passenger_count", "long", 0, 9),
            _c("trip_distance", "double", 0, 1e6),
            _c("rate_code_id", "long", 1, 99),
            _c("store_and_fwd_flag", "string"),
            _c("pu_location_id", "long", 1, 265),
            _c("do_location_id", "long", 1, 265),
            _c("payment_type", "long", 0, 6),
            _c("fare_amount", "double", -1000, 5000),
            _c("extra", "double", -10, 100),
            _c("mta_tax", "double", -10, 100),
            _c("tip_amount", "double", -200, 5000),
            _c("tolls_amount", "double", -100, 1000),
            _c("improvement_surcharge", "double", -10, 10),
            _c("congestion_surcharge", "double", -10, 10),
            _c("airport_fee", "double", -10, 10),
            _c("total_amount", "double", -1000, 10000),
            _c("ingest_ts", "timestamp", nullable=False),
            _c("event_date", "date", nullable=False),
        ),
    ),
    "pickup_zone_demand": TableContract(
        "pickup_zone_demand",
        (
            _c("pu_location_id", "long", 1, 265, nullable=False),
            _c("pickup_datetime", "timestamp", nullable=False),
            _c("event_date", "date", nullable=False),
            *[_c(f"pu_pickup_count_{w}", "long", 0, 1e7, nullable=False) for w in ("1h", "6h", "24h")],
            *[_c(f"pu_mean_fare_{w}", "double", -1000, 5000) for w in ("1h", "6h", "24h")],
        ),
    ),
    "driver_trip_history": TableContract(
        "driver_trip_history",
        (
            _c("vendor_id", "long", 1, 6, nullable=False),
            _c("pickup_datetime", "timestamp", nullable=False),
            _c("event_date", "date", nullable=False),
            *[_c(f"driver_trip_count_{w}", "long", 0, 1e7, nullable=False) for w in ("7d", "30d")],
            *[_c(f"driver_mean_trip_distance_{w}", "double", 0, 5000) for w in ("7d", "30d")],
            *[_c(f"driver_mean_tip_ratio_{w}", "double", 0, 1) for w in ("7d", "30d")],
        ),
        ("vendor_id", "event_date"),
    ),
    "trip_features": TableContract(
        "trip_features",
        (
            _c("vendor_id", "long"),
            _c("pu_location_id", "long", 1, 265),
            _c("pickup_datetime", "timestamp", nullable=False),
            _c("event_date", "date", nullable=False),
            _c("fare_amount", "double", -1000, 5000),
            _c("tip_pct", "double", 0, 1),
            _c("pu_pickup_count_1h", "long", 0, 1e7),
            _c("pu_pickup_count_24h", "long", 0, 1e7),
            _c("pu_mean_fare_24h", "double", -1000, 5000),
            _c("driver_trip_count_7d", "long", 0, 1e7),
            _c("driver_mean_tip_ratio_7d", "double", 0, 1),
        ),
    ),
}


def schema_violations(df: DataFrame, contract: TableContract, strict: bool = False) -> list[str]:
    """Missing columns and wrong types; with strict, extra columns too."""
    have = {f.name: f.dataType for f in df.schema.fields}
    missing = [f"missing column {f.name}" for f in contract if f.name not in have]
    wrong = [f"{f.name}: {have[f.name].simpleString()} instead of {f.dataType.simpleString()}" for f in contract if f.name in have and have[f.name] != f.dataType]
    extra = [f"extra column {n}" for n in have if strict and n not in contract.names]
    return missing + wrong + extra


def rules(contract: TableContract) -> Iterator[tuple[str, Column]]:
    """(rule, whether a row breaks it), for each rule."""
    for f in contract:
        value = F.col(f"`{f.name}`")
        if not f.nullable:
            yield f"{f.name}: null", value.isNull()
        broken = [FORBIDS[k](value, F.lit(bound)) for k, bound in f.metadata.items()]
        if broken:
            yield f"{f.name}: out of range", F.coalesce(F.greatest(*broken, F.lit(False)), F.lit(False))


def value_counters(contract: TableContract) -> dict[str, Column]:
    """Counting expressions, one for each rule."""
    return {name: F.count_if(broken) for name, broken in rules(contract)}


def check_contract(df: DataFrame, contract: TableContract, strict: bool = False) -> list[str]:
    """Violations, as text. The schema comes first; values are counted only where it holds."""
    found = schema_violations(df, contract, strict)
    counters = value_counters(contract)
    if found or not counters:
        return found
    row = df.agg(*[c.alias(f"c{i}") for i, c in enumerate(counters.values())]).first()
    return [f"{name} in {n} rows" for name, n in zip(counters, row, strict=True) if n]


def enforce_contract(df: DataFrame, contract: TableContract, strict: bool = False) -> DataFrame:
    if found := check_contract(df, contract, strict):
        raise DataQualityError(f"{contract.name}: " + "; ".join(found))
    return df
