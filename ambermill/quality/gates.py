"""Quality gates before a write.

Contract counts, null rates, row count and freshness come from ONE aggregate over the table; only the
primary key and the partition floor need a shuffle by their keys.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ambermill.control import DataQualityError
from ambermill.quality.contracts import TableContract, schema_violations, value_counters


@dataclass(frozen=True)
class CheckResult:
    name: str
    passed: bool
    measured: object
    threshold: object


def null_rate(col: str) -> Column:
    return F.avg(F.col(f"`{col}`").isNull().cast("double"))


def check_null_rates(df: DataFrame, ceilings: Mapping[str, float]) -> list[CheckResult]:
    """Share of NULLs of each column. An empty table has no rate and fails."""
    if not ceilings:
        return []
    row = df.agg(*[null_rate(c).alias(f"r{i}") for i, c in enumerate(ceilings)]).first()
    return [_null_result(c, row[i], top) for i, (c, top) in enumerate(ceilings.items())]


def _null_result(col: str, rate: float | None, ceiling: float) -> CheckResult:
    return CheckResult(f"null_rate:{col}", rate is not None and rate <= ceiling, rate, ceiling)


def duplicate_key_groups(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)


def check_primary_key_unique(df: DataFrame, keys: Sequence[str]) -> CheckResult:
    n = duplicate_key_groups(df, keys).count()
    return CheckResult("primary_key_unique", n == 0, n, 0)


def check_row_count_floor(n: int, floor: int) -> CheckResult:
    return CheckResult("row_count_floor", n >= floor, n, floor)


def partition_counts(df: DataFrame, col: str = "event_date") -> DataFrame:
    return df.groupBy(col).agg(F.count(F.lit(1)).alias("n"))


def partitions_below_floor(df: DataFrame, prior: DataFrame, ratio: float, col: str = "event_date") -> DataFrame:
    """Partitions with fewer rows than ratio x before; those that vanished count as 0 rows."""
    now = partition_counts(df, col).withColumnRenamed("n", "now_n")
    before = partition_counts(prior, col).withColumnRenamed("n", "prior_n")
    joined = before.join(now, col, "left").select(col, "prior_n", F.coalesce("now_n", F.lit(0)).alias("now_n"))
    return joined.where(F.col("now_n") < F.col("prior_n") * F.lit(ratio))


def check_partition_floor(df: DataFrame, prior: DataFrame | None, ratio: float, col: str = "event_date") -> CheckResult:
    n = 0 if prior is None else partitions_below_floor(df, prior, ratio, col).count()
    return CheckResult("partition_row_floor", n == 0, n, 0)


def _absent(name: str, columns: Iterable[str]) -> CheckResult:
    """A gate on columns that the table lacks fails."""
    return CheckResult(name, False, f"missing column(s) {sorted(columns)}", 0)


def results_frame(spark: SparkSession, results: Sequence[CheckResult]) -> DataFrame:
    """Gate results as a table."""
    return spark.createDataFrame([(r.name, r.passed, str(r.measured), str(r.threshold)) for r in results], "name string, passed boolean, measured string, threshold string")


def _instant(x: datetime | str) -> datetime:
    return (x if isinstance(x, datetime) else datetime.fromisoformat(x)).replace(tzinfo=None)


def _fresh(newest: datetime | None, lower: datetime | str, upper: datetime | str) -> CheckResult:
    ok = newest is not None and _instant(lower) <= _instant(newest) <= _instant(upper)
    return CheckResult("freshness", ok, newest, f"{lower}..{upper}")


def check_freshness(df: DataFrame, ts_col: str, lower: datetime | str, upper: datetime | str) -> CheckResult:
    return _fresh(df.agg(F.max(F.to_timestamp_ntz(F.col(ts_col).cast("string")))).first()[0], lower, upper)


def run_gates(
    df: DataFrame,
    contract: TableContract | None = None,
    null_rate_ceilings: Mapping[str, float] | None = None,
    primary_key: Sequence[str] = (),
    min_rows: int | None = None,
    prior: DataFrame | None = None,
    partition_floor_ratio: float | None = None,
    partition_col: str = "event_date",
    freshness: Mapping[str, str] | None = None,
    record: Callable[[CheckResult], None] | None = None,
) -> tuple[list[CheckResult], int | None]:
    """Run all gates, record all results, then raise one error that names every failure. Returns (results, rows)."""
    results: list[CheckResult] = []
    bad_schema = schema_violations(df, contract) if contract else []
    have = set(df.columns)
    aggs: dict[str, Column] = {"rows": F.count(F.lit(1))}
    counters = value_counters(contract) if contract and not bad_schema else {}
    aggs |= {f"c:{k}": v for k, v in counters.items()}
    ceilings = dict(null_rate_ceilings or {})
    aggs |= {f"n:{c}": null_rate(c) for c in ceilings if c in have}
    if freshness and freshness["ts_col"] in have:
        aggs["fresh"] = F.max(F.to_timestamp_ntz(F.col(freshness["ts_col"]).cast("string")))
    row = dict(zip(aggs, df.agg(*[c.alias(f"a{i}") for i, c in enumerate(aggs.values())]).first(), strict=True))
    if contract:
        found = bad_schema or [f"{k} in {row[f'c:{k}']} rows" for k in counters if row[f"c:{k}"]]
        results.append(CheckResult(f"contract:{contract.name}", not found, "; ".join(found) or "ok", "ok"))
    results += [_null_result(c, row.get(f"n:{c}"), top) for c, top in ceilings.items()]
    keys = list(primary_key or (contract.primary_key if contract else ()))
    if keys:
        results.append(check_primary_key_unique(df, keys) if set(keys) <= have else _absent("primary_key_unique", set(keys) - have))
    if min_rows is not None:
        results.append(check_row_count_floor(row["rows"], min_rows))
    if partition_floor_ratio is not None:
        lacks = partition_col not in have or (prior is not None and partition_col not in prior.columns)
        results.append(_absent("partition_row_floor", {partition_col}) if lacks else check_partition_floor(df, prior, partition_floor_ratio, partition_col))
    if freshness:
        results.append(_fresh(row.get("fresh"), freshness["lower"], freshness["upper"]))
    for r in results:
        if record:
            record(r)
    failed = [r for r in results if not r.passed]
    if failed:
        raise DataQualityError("; ".join(f"{r.name}: {r.measured} (threshold {r.threshold})" for r in failed))
    return results, row["rows"]
