"""Run registries: feature runs, quality results, model runs.

The store is SQLite (standard library) behind a DB-API connection; the rule of one success
a key is a partial unique index. as_dataframe() gives a registry to Spark, and latest_feature_runs() is
the same query as a DataFrame.
"""

from __future__ import annotations

import json
import sqlite3
import subprocess
import uuid
from collections.abc import Iterable, Sequence
from datetime import datetime, timezone
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ambermill.operators.relational import first_per_group

SCHEMA = """
CREATE TABLE IF NOT EXISTS feature_runs (
  run_id TEXT PRIMARY KEY, feature_group TEXT NOT NULL, run_key TEXT, status TEXT NOT NULL, row_count INTEGER,
  input_paths TEXT, output_path TEXT, config TEXT, code_version TEXT, started_at TEXT NOT NULL, finished_at TEXT);
CREATE UNIQUE INDEX IF NOT EXISTS one_success_per_key ON feature_runs(run_key) WHERE status = 'success';
CREATE TABLE IF NOT EXISTS quality_results (
  id INTEGER PRIMARY KEY AUTOINCREMENT, run_id TEXT REFERENCES feature_runs(run_id), table_name TEXT NOT NULL, check_name TEXT NOT NULL,
  passed INTEGER NOT NULL, measured TEXT, threshold TEXT, checked_at TEXT NOT NULL);
CREATE TABLE IF NOT EXISTS model_runs (
  run_id TEXT PRIMARY KEY, framework TEXT NOT NULL, params TEXT, metrics TEXT, artifact_path TEXT, code_version TEXT, created_at TEXT NOT NULL);
CREATE TABLE IF NOT EXISTS model_run_features (
  model_run_id TEXT NOT NULL REFERENCES model_runs(run_id), feature_run_id TEXT NOT NULL REFERENCES feature_runs(run_id),
  PRIMARY KEY (model_run_id, feature_run_id));
"""


def _now() -> str:
    return datetime.now(timezone.utc).isoformat()


def code_version(folder: str | Path = ".") -> str | None:
    """Commit of the working copy; None where there is none."""
    try:
        said = subprocess.run(["git", "-C", str(folder), "rev-parse", "HEAD"], capture_output=True, text=True, timeout=10)
    except (OSError, subprocess.TimeoutExpired):
        return None
    return said.stdout.strip() or None if said.returncode == 0 else None


class RunRegistry:
    def __init__(self, path: str = ":memory:") -> None:
        if path != ":memory:":
            Path(path).parent.mkdir(parents=True, exist_ok=True)
        self.db = sqlite3.connect(path, timeout=10)
        self.db.execute("PRAGMA foreign_keys = ON")
        self.db.executescript(SCHEMA)

    def close(self) -> None:
        self.db.close()

    def start_run(self, group: str, key: str | None, inputs: Sequence[str], output: str, config: dict | None = None, version: str | None = None) -> str:
        run_id = str(uuid.uuid4())
        with self.db:
            self.db.execute(
                "INSERT INTO feature_runs (run_id, feature_group, run_key, status, input_paths, output_path, config, code_version, started_at) "
                "VALUES (?, ?, ?, 'running', ?, ?, ?, ?, ?)",
                (run_id, group, key, json.dumps(list(inputs)), output, json.dumps(config or {}, default=str), version, _now()),
            )
        return run_id

    def is_completed(self, key: str | None) -> bool:
        if not key:
            return False
        return self.db.execute("SELECT 1 FROM feature_runs WHERE run_key = ? AND status = 'success' LIMIT 1", (key,)).fetchone() is not None

    def finish_run(self, run_id: str, status: str, row_count: int | None = None, supersede: bool = False) -> None:
        """Close a run. supersede: an earlier success of its key gives way, in the same transaction."""
        if status not in ("success", "failed"):
            raise ValueError(f"status must be success or failed, got {status!r}")
        with self.db:
            if supersede and status == "success":
                self.db.execute(
                    "UPDATE feature_runs SET status = 'superseded' WHERE status = 'success' AND run_key = (SELECT run_key FROM feature_runs WHERE run_id = ?)",
                    (run_id,),
                )
            self.db.execute("UPDATE feature_runs SET status = ?, row_count = ?, finished_at = ? WHERE run_id = ?", (status, row_count, _now(), run_id))

    def supersede(self, key: str) -> int:
        with self.db:
            return self.db.execute("UPDATE feature_runs SET status = 'superseded' WHERE run_key = ? AND status = 'success'", (key,)).rowcount

    def record_result(self, table: str, check: str, passed: bool, measured, threshold, run_id: str | None = None) -> None:
        with self.db:
            self.db.execute(
                "INSERT INTO quality_results (run_id, table_name, check_name, passed, measured, threshold, checked_at) VALUES (?, ?, ?, ?, ?, ?, ?)",
                (run_id, table, check, int(passed), str(measured), str(threshold), _now()),
            )

    def register_model_run(self, framework: str, params: dict, metrics: dict, artifact: str, feature_runs: Iterable[str], version: str | None = None) -> str:
        run_id = str(uuid.uuid4())
        with self.db:
            self.db.execute(
                "INSERT INTO model_runs VALUES (?, ?, ?, ?, ?, ?, ?)",
                (run_id, framework, json.dumps(params, default=str), json.dumps(metrics, default=str), artifact, version, _now()),
            )
            self.db.executemany("INSERT INTO model_run_features VALUES (?, ?)", [(run_id, f) for f in dict.fromkeys(feature_runs)])
        return run_id

    def latest_feature_runs(self, groups: Sequence[str]) -> dict[str, str]:
        """The latest successful run of each group asked for."""
        marks = ",".join("?" * len(groups))
        rows = self.db.execute(
            f"SELECT feature_group, run_id FROM (SELECT *, row_number() OVER (PARTITION BY feature_group ORDER BY finished_at DESC, run_id DESC) AS rn "
            f"FROM feature_runs WHERE status = 'success' AND feature_group IN ({marks})) WHERE rn = 1",
            list(groups),
        ).fetchall()
        return dict(rows)

    def as_dataframe(self, spark: SparkSession, table: str) -> DataFrame:
        if table not in ("feature_runs", "quality_results", "model_runs", "model_run_features"):
            raise ValueError(f"unknown registry {table!r}")
        cur = self.db.execute(f"SELECT * FROM {table}")
        names = [d[0] for d in cur.description]
        kinds = {"row_count": "long", "id": "long", "passed": "long"}
        return spark.createDataFrame(cur.fetchall(), ", ".join(f"{n} {kinds.get(n, 'string')}" for n in names))


def latest_runs(runs: DataFrame, groups: Sequence[str]) -> DataFrame:
    """latest_feature_runs over a registry table."""
    ok = runs.where((F.col("status") == "success") & F.col("feature_group").isin(list(groups)))
    return first_per_group(ok, ["feature_group"], [F.col("finished_at").desc_nulls_last(), F.col("run_id").desc()])
