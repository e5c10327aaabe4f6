"""Staged replacement, gates and contracts."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from ambermill.control import DataQualityError
from ambermill.quality.contracts import TableContract, check_contract, column, enforce_contract
from ambermill.quality.gates import check_freshness, check_null_rates, check_partition_floor, check_primary_key_unique, run_gates
from ambermill.sources.tables import exists, hadoop_path, read_if_exists, read_table, table_stats, write_table
from ambermill.sources.writer import TableWriter


def days(spark, n, value=0):
    return spark.createDataFrame([(i, f"2023-01-0{1 + i % 3}", value) for i in range(n)], "id int, event_date string, value int")


def test_replace_writes_partitions_and_marks(spark, tmp_path):
    t, w = str(tmp_path / "t"), TableWriter(spark)
    assert w.replace(days(spark, 6), t, ["event_date"]) == 3
    assert w.is_complete(t) and (tmp_path / "t" / "_SUCCESS").exists()
    assert w.replace(days(spark, 4, 1), t, ["event_date"]) == 3
    assert table_stats(spark, t, "event_date") == {"rows": 4, "partitions": 3}
    assert sorted(p.name for p in tmp_path.iterdir()) == ["t"]


@pytest.mark.parametrize("stop_at", [1, 2])
def test_stopped_between_renames(spark, tmp_path, monkeypatch, stop_at):
    """A promotion that dies at a rename leaves the old table, or lets the next one restore it."""
    t, w = str(tmp_path / "t"), TableWriter(spark)
    w.replace(days(spark, 3), t)
    staged, renames, real = w.stage(days(spark, 5), t), [], TableWriter._rename

    def rename(self, fs, src, dst):
        renames.append(1)
        if len(renames) == stop_at:
            raise OSError("gone")
        return real(self, fs, src, dst)

    monkeypatch.setattr(TableWriter, "_rename", rename)
    with pytest.raises(OSError):
        w.promote(staged, t)
    assert read_table(spark, t).count() == 3 and w.is_complete(t)
    assert w.promote(staged, t) == 1 and read_table(spark, t).count() == 5


def test_killed_before_the_rollback(spark, tmp_path):
    t, w = str(tmp_path / "t"), TableWriter(spark)
    w.replace(days(spark, 3), t)
    fs, final = hadoop_path(spark, t)
    assert fs.rename(final, hadoop_path(spark, w.trash_path(t))[1])
    assert w.replace(days(spark, 2), t) == 1 and read_table(spark, t).count() == 2


def test_rollback_spares_another_writers_table(spark, tmp_path, monkeypatch):
    t, w = str(tmp_path / "t"), TableWriter(spark)
    w.replace(days(spark, 3), t)
    staged, real = w.stage(days(spark, 5), t), TableWriter._rename

    def rename(self, fs, src, dst):
        real(self, fs, src, dst)
        if str(dst).endswith(".trash"):
            write_table(days(spark, 7), t)

    monkeypatch.setattr(TableWriter, "_rename", rename)
    with pytest.raises(FileExistsError):
        w.promote(staged, t)
    assert read_table(spark, t).count() == 7


def test_nothing_staged_and_stale_folders(spark, tmp_path):
    t, w = str(tmp_path / "t"), TableWriter(spark, stale_after_s=-60)
    with pytest.raises(FileNotFoundError):
        w.promote(w.staging_path(t, "x"), t)
    w.stage(days(spark, 1), t, run_id="old")
    w.stage(days(spark, 1), t, run_id="new")
    assert not exists(spark, w.staging_path(t, "old")) and exists(spark, w.staging_path(t, "new"))
    assert read_if_exists(spark, t) is None


CONTRACT = TableContract("c", [column("id", "long", nullable=False), column("fare", "double", -10, 100), column("share", "double", 0, 1), column("day", "string", nullable=False)], ["id"])
GOOD = [(1, 10.0, 0.2, "2023-01-01"), (2, 20.0, 0.1, "2023-01-02")]
KIND = "id long, fare double, share double, day string"


@pytest.mark.parametrize(
    "rows, kind, said",
    [
        (GOOD, KIND, None),
        ([(1, -50.0, 0.1, "a")], KIND, "fare: out of range in 1 rows"),
        ([(1, float("nan"), 0.1, "a")], KIND, "fare: out of range"),
        ([(None, 1.0, 0.1, "a")], KIND, "id: null in 1 rows"),
        ([(1, 1.0, 7.5, "a"), (2, None, None, "a")], KIND, "share: out of range in 1 rows"),
        ([(1, "x", 0.1, "a")], KIND.replace("fare double", "fare string"), "fare: string instead of double"),
        ([(1, 1.0, 0.1)], "id long, fare double, share double", "missing column day"),
    ],
)
def test_contract(spark, rows, kind, said):
    df = spark.createDataFrame(rows, kind)
    if said is None:
        assert check_contract(df, CONTRACT) == [] and enforce_contract(df, CONTRACT) is df
        assert check_contract(df.withColumn("more", F.lit(1)), CONTRACT, strict=True) == ["extra column more"]
    else:
        assert said in "; ".join(check_contract(df, CONTRACT))
        with pytest.raises(DataQualityError):
            enforce_contract(df, CONTRACT)


def test_single_gates(spark):
    df = spark.createDataFrame([(1.0, None), (2.0, None), (3.0, 1.0)], "v double, w double")
    assert [r.passed for r in check_null_rates(df, {"v": 0.0, "w": 0.1})] == [True, False]
    assert check_null_rates(df, {"w": 0.8})[0].passed and not check_null_rates(df.limit(0), {"v": 1.0})[0].passed
    ids = lambda *x: spark.createDataFrame([(i,) for i in x], "id long")
    assert check_primary_key_unique(ids(1, 2), ["id"]).passed and not check_primary_key_unique(ids(1, 1, 2), ["id"]).passed
    ts = spark.createDataFrame([(datetime(2023, 1, 5, 10),)], "ts timestamp")
    assert check_freshness(ts, "ts", "2023-01-01", "2023-02-01").passed and not check_freshness(ts, "ts", "2024-01-01", "2024-02-01").passed
    part = lambda *n: spark.createDataFrame([(d,) for d, k in enumerate(n) for _ in range(k)], "event_date int")
    assert check_partition_floor(part(2, 2), None, 0.9).passed and check_partition_floor(part(2, 2), part(2, 2), 0.9).passed
    assert check_partition_floor(part(2, 1), part(2, 2), 0.9).measured == 1 and check_partition_floor(part(2, 0), part(2, 2), 0.9).measured == 1


def test_run_gates_records_all_then_raises_once(spark):
    df, seen = spark.createDataFrame(GOOD, KIND).withColumn("event_date", F.lit(date(2023, 1, 1))), []
    found, rows = run_gates(df, CONTRACT, {"fare": 0.0}, (), 2, df, 0.9, record=seen.append)
    assert rows == 2 and seen == found and [r.name for r in found] == ["contract:c", "null_rate:fare", "primary_key_unique", "row_count_floor", "partition_row_floor"]
    with pytest.raises(DataQualityError) as e:
        run_gates(df, CONTRACT, {"fare": 0.0, "absent": 0.5}, ["absent"], 3, None, 0.9, "nope", {"ts_col": "gone", "lower": "2023-01-01", "upper": "2023-02-01"})
    for name in ("null_rate:absent", "primary_key_unique", "row_count_floor", "partition_row_floor", "freshness"):
        assert name in str(e.value)


def test_missing_columns_fail_their_gates(spark):
    df = spark.createDataFrame([(1,)], "id long")
    with pytest.raises(DataQualityError, match="primary_key_unique.*partition_row_floor"):
        run_gates(df, primary_key=["absent"], partition_floor_ratio=0.9, partition_col="nope")
