"""Stage metrics from Spark's REST interface, and the CSV log of benches."""

from __future__ import annotations

import csv
import json
import os
import urllib.request
from collections.abc import Mapping

from pyspark.sql import SparkSession


def fetch_json(url: str, timeout: float = 10.0):
    with urllib.request.urlopen(url, timeout=timeout) as r:
        return json.load(r)


def stages_url(spark: SparkSession) -> str:
    base = spark.sparkContext.uiWebUrl
    if not base:
        raise RuntimeError("the UI is off; set spark.ui.enabled=true to read stage metrics")
    return f"{base}/api/v1/applications/{spark.sparkContext.applicationId}/stages"


def completed(stages: list[dict]) -> list[dict]:
    return [s for s in stages if s.get("status") == "COMPLETE"]


def max_completed_stage_id(spark: SparkSession) -> int:
    return max((s["stageId"] for s in completed(fetch_json(stages_url(spark)))), default=-1)


def stage_metrics(stages: list[dict], after_stage: int) -> dict:
    """Count, longest task (ms) and shuffle bytes read of the stages completed after a stage id."""
    own = [s for s in completed(stages) if s["stageId"] > after_stage]
    longest = 0
    for s in own:
        tasks = s.get("tasks") or {}
        tasks = tasks.values() if isinstance(tasks, Mapping) else tasks
        longest = max([longest, *((t.get("taskMetrics") or {}).get("executorRunTime", 0) for t in tasks)])
    return {"stages": len(own), "max_task_ms": longest, "shuffle_read_bytes": sum(s.get("shuffleReadBytes", 0) for s in own)}


def collect_stage_metrics(spark: SparkSession, after_stage: int) -> dict:
    return stage_metrics(fetch_json(stages_url(spark) + "?details=true"), after_stage)


def append_csv(path: str, row: Mapping) -> None:
    """Append a row; the header comes once."""
    new = not os.path.exists(path) or os.path.getsize(path) == 0
    os.makedirs(os.path.dirname(os.path.abspath(path)), exist_ok=True)
    with open(path, "a", newline="") as f:
        w = csv.DictWriter(f, list(row))
        if new:
            w.writeheader()
        w.writerow(row)
