"""Raw trips to the bronze table."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ambermill.functions.columns import add_derived_columns, cast_columns, normalize_columns
from ambermill.quality.contracts import CONTRACTS
from ambermill.quality.gates import run_gates
from ambermill.registry import RunRegistry
from ambermill.sources.tables import read_if_exists, read_table, table_stats
from ambermill.sources.writer import TableWriter


def date_range(df: DataFrame, col: str, start: str | None = None, end: str | None = None) -> DataFrame:
    """Both bounds count; date literals prune partitions where col is one."""
    if start:
        df = df.where(F.col(col) >= F.lit(start).cast("date"))
    if end:
        df = df.where(F.col(col) <= F.lit(end).cast("date"))
    return df


def bronze_frame(raw: DataFrame, start: str | None = None, end: str | None = None) -> DataFrame:
    return date_range(add_derived_columns(cast_columns(normalize_columns(raw))), "event_date", start, end)


def run_bronze(spark: SparkSession, raw_path: str, bronze_path: str, start: str | None = None, end: str | None = None, registry: RunRegistry | None = None) -> dict:
    """Ingest, gate, replace, read back. The row floor is half of the rows whose date lies in the range asked for."""
    raw = read_table(spark, raw_path)
    df = bronze_frame(raw, start, end).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return _gate_and_replace(spark, raw, df, bronze_path, start, end, registry)
    finally:
        df.unpersist()


def _gate_and_replace(spark: SparkSession, raw: DataFrame, df: DataFrame, bronze_path: str, start: str | None, end: str | None, registry: RunRegistry | None) -> dict:
    expected = date_range(raw.select(F.to_date(F.col(_pickup(raw))).alias("event_date")), "event_date", start, end).count()
    run_gates(
        df,
        contract=CONTRACTS["trips"],
        null_rate_ceilings={"pickup_datetime": 0.0, "event_date": 0.0, "ingest_ts": 0.0},
        min_rows=max(1, expected // 2),
        prior=read_if_exists(spark, bronze_path),
        partition_floor_ratio=0.9,
        record=(lambda r: registry.record_result("trips", r.name, r.passed, r.measured, r.threshold)) if registry else None,
    )
    TableWriter(spark).replace(df, bronze_path, ["event_date"])
    return table_stats(spark, bronze_path, "event_date")


def _pickup(raw: DataFrame) -> str:
    return "tpep_pickup_datetime" if "tpep_pickup_datetime" in raw.columns else "pickup_datetime"
