"""Building feature groups: skip, gate, write, register."""

from __future__ import annotations

import sqlite3
from collections.abc import Callable, Mapping, Sequence

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

from ambermill.config import resolve_path, table_path
from ambermill.control import retry
from ambermill.functions.columns import run_key
from ambermill.plans.features import compute_driver_trip_history, compute_pickup_zone_demand, compute_trip_features
from ambermill.plans.specs import FeatureSpec, load_specs
from ambermill.quality.contracts import CONTRACTS
from ambermill.quality.gates import run_gates
from ambermill.registry import RunRegistry, code_version
from ambermill.sources.tables import hadoop_path, read_if_exists, read_table
from ambermill.sources.writer import TableWriter

ORDER = ("pickup_zone_demand", "driver_trip_history", "trip_features")


def input_fingerprint(spark: SparkSession, paths: Sequence[str]) -> str:
    """Size, file count and time of each input, so that new content makes a new key."""
    out = []
    for path in sorted(paths):
        fs, p = hadoop_path(spark, path)
        s = fs.getContentSummary(p)
        out.append(f"{path}:{s.getLength()}:{s.getFileCount()}:{fs.getFileStatus(p).getModificationTime()}")
    return "|".join(out)


def build_and_register(
    spark: SparkSession, spec: FeatureSpec, compute: Callable[[], DataFrame], inputs: Sequence[str], output: str,
    registry: RunRegistry | None = None, force: bool = False, version: str | None = None, quality: Mapping | None = None,
) -> dict:
    """No-op where the same code has built the same inputs; else compute, gate, replace and register."""
    version = version or code_version() or "uncommitted"
    key = run_key(spec.name, version, inputs, input_fingerprint(spark, inputs))
    if registry and not force and registry.is_completed(key):
        return {"group": spec.name, "skipped": True, "rows": None}
    run_id = registry.start_run(spec.name, key, inputs, output, {"quality": dict(spec.quality)}, version) if registry else None
    df = compute().persist(StorageLevel.MEMORY_AND_DISK)
    try:
        q = dict(spec.quality if quality is None else quality)
        _, rows = run_gates(
            df, CONTRACTS.get(spec.name), q.get("null_rate_ceilings"), (), q.get("min_rows"), read_if_exists(spark, output),
            q.get("partition_floor_ratio"), spec.event_date_col, q.get("freshness"),
            (lambda r: registry.record_result(spec.name, r.name, r.passed, r.measured, r.threshold, run_id)) if registry else None,
        )
        TableWriter(spark).replace(df, output, [spec.event_date_col])
    except Exception:
        if registry:
            registry.finish_run(run_id, "failed")
        raise
    finally:
        df.unpersist()
    if registry:  # the table is replaced by now: only the entry is tried again, not the build
        retry(lambda: registry.finish_run(run_id, "success", rows, supersede=force), is_retryable=lambda exc: isinstance(exc, sqlite3.OperationalError))
    return {"group": spec.name, "skipped": False, "rows": rows}


def build_silver(
    spark: SparkSession, bronze_path: str, silver_root: str, groups: Sequence[str] | None = None, registry: RunRegistry | None = None,
    force: bool = False, specs: Mapping[str, FeatureSpec] | None = None, quality: Mapping[str, Mapping] | None = None,
) -> list[dict]:
    """Build the groups asked for, in order. trip_features reads the promoted tables of the other two."""
    specs = specs or load_specs()
    wanted = list(groups or ORDER)
    if unknown := set(wanted) - set(ORDER):
        raise SystemExit(f"unknown feature groups {sorted(unknown)}; choose from {list(ORDER)}")
    bronze_path = resolve_path(bronze_path)
    out = {g: resolve_path(table_path(silver_root, specs[g].output.split("/")[-1])) for g in ORDER}
    bronze = read_table(spark, bronze_path)
    plans = {
        "pickup_zone_demand": ([bronze_path], lambda: compute_pickup_zone_demand(bronze, specs["pickup_zone_demand"])),
        "driver_trip_history": ([bronze_path], lambda: compute_driver_trip_history(bronze, specs["driver_trip_history"])),
        "trip_features": (
            [bronze_path, out["pickup_zone_demand"], out["driver_trip_history"]],
            lambda: compute_trip_features(bronze, read_table(spark, out[ORDER[0]]), read_table(spark, out[ORDER[1]]), specs["trip_features"]),
        ),
    }
    return [
        retry(lambda g=g: build_and_register(spark, specs[g], plans[g][1], plans[g][0], out[g], registry, force, quality=(quality or {}).get(g)))
        for g in ORDER
        if g in wanted
    ]
