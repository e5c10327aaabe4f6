"""Retries, run registry, configuration and paths."""

import logging

import pytest

from ambermill.config import load_config, resolve_path, table_path
from ambermill.control import DataQualityError, is_transient_error, pauses, retry
from ambermill.plans.specs import load_specs, parse_spec
from ambermill.registry import RunRegistry, latest_runs
from ambermill.sources.metrics import append_csv, stage_metrics


def failing(times, error):
    calls = []

    def fn():
        calls.append(1)
        if len(calls) <= times:
            raise error
        return len(calls)

    return fn, calls


def test_retries_transient_errors_and_logs(caplog):
    fn, slept = failing(2, OSError("Connection reset by peer"))[0], []
    with caplog.at_level(logging.WARNING):
        assert retry(fn, attempts=3, jitter=0, sleep=slept.append) == 3
    assert slept == [1.0, 2.0] and len(caplog.records) == 2


def test_gives_up_after_the_last_attempt_without_a_pause():
    (fn, calls), slept = failing(9, TimeoutError()), []
    with pytest.raises(TimeoutError):
        retry(fn, attempts=3, sleep=slept.append)
    assert len(calls) == 3 and len(slept) == 2


@pytest.mark.parametrize("error", [DataQualityError("timeout"), ValueError("bad input"), KeyError("row 15030"), TypeError("typeof x")])
def test_permanent_errors_are_not_tried_again(error):
    fn, calls = failing(9, error)
    with pytest.raises(type(error)):
        retry(fn, sleep=lambda s: None)
    assert len(calls) == 1


@pytest.mark.parametrize("said", ["status 503", "HTTP 429", "AmazonS3Exception", "Throttling", "500 Internal Server Error", "EOFException", "read timed out"])
def test_transient_phrases(said):
    assert is_transient_error(RuntimeError(said))


def test_pauses_double_up_to_the_most_and_jitter():
    assert list(pauses(6, 1, 5, 0)) == [1, 2, 4, 5, 5]
    assert list(pauses(3, 1, 60, 1, rng=lambda: 0.5)) == [0.5, 1.0]
    assert list(pauses(2, 10, 60, 0.2, rng=lambda: 1.0)) == [11.0]
    with pytest.raises(ValueError):
        retry(lambda: 1, attempts=0)


def test_registry_one_success_a_key(spark):
    r = RunRegistry()
    a = r.start_run("g", "k", ["in"], "out", {"x": 1}, "v1")
    assert not r.is_completed("k") and not r.is_completed(None)
    r.finish_run(a, "success", 5)
    b = r.start_run("g", "k", ["in"], "out")
    with pytest.raises(Exception, match="UNIQUE"):
        r.finish_run(b, "success", 6)
    r.finish_run(b, "success", 6, supersede=True)
    c = r.start_run("h", "k2", [], "out")
    r.finish_run(c, "failed")
    assert r.is_completed("k") and not r.is_completed("k2")
    assert r.latest_feature_runs(["g", "h"]) == {"g": b}
    assert [x.run_id for x in latest_runs(r.as_dataframe(spark, "feature_runs"), ["g", "h"]).collect()] == [b]
    r.record_result("t", "rows", True, 5, 1, b)
    m = r.register_model_run("sparkml", {"depth": 5}, {"rmse": 0.1}, "/a", [b, b])
    assert r.as_dataframe(spark, "model_run_features").collect()[0].asDict() == {"model_run_id": m, "feature_run_id": b}
    assert r.as_dataframe(spark, "quality_results").count() == 1
    assert r.supersede("k") == 1 and not r.is_completed("k")
    with pytest.raises(ValueError):
        r.finish_run(c, "done")
    with pytest.raises(Exception, match="FOREIGN"):
        r.record_result("t", "rows", True, 5, 1, "no such run")


def test_configuration_and_paths(tmp_path, monkeypatch):
    monkeypatch.delenv("APP_ENV", raising=False)
    assert load_config() == load_config("local")
    monkeypatch.setenv("APP_ENV", "k8s")
    assert load_config() == load_config("k8s")
    with pytest.raises(FileNotFoundError, match="choose one of"):
        load_config("nowhere")
    assert resolve_path("s3a://b/t") == "s3a://b/t" and resolve_path("/x") == "/x" and resolve_path("t", "/r") == "/r/t"
    assert table_path("s3a://b/", "/silver/", "t") == "s3a://b/silver/t"
    assert {"pickup_zone_demand", "driver_trip_history", "trip_features"} <= load_specs().keys()
    with pytest.raises(ValueError, match="unknown keys"):
        parse_spec("x", {"entity_key": ["a"], "event_ts_col": "t", "event_date_col": "d", "output": "o", "colour": 1})


def test_csv_log_and_stage_metrics(tmp_path):
    for n in (1, 2):
        append_csv(str(tmp_path / "log" / "a.csv"), {"n": n, "s": "x"})
    assert (tmp_path / "log" / "a.csv").read_text().split() == ["n,s", "1,x", "2,x"]
    stages = [
        {"stageId": 1, "status": "COMPLETE", "shuffleReadBytes": 7},
        {"stageId": 2, "status": "COMPLETE", "shuffleReadBytes": 5, "tasks": {"0": {"taskMetrics": {"executorRunTime": 30}}}},
        {"stageId": 3, "status": "FAILED", "shuffleReadBytes": 9},
    ]
    assert stage_metrics(stages, 1) == {"stages": 1, "max_task_ms": 30, "shuffle_read_bytes": 5}
