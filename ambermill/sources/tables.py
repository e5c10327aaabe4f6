"""Reading and writing Parquet tables, month ranges, file download."""

from __future__ import annotations

import os
import shutil
import urllib.request
from collections.abc import Sequence
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ambermill.config import resolve_path


def hadoop_path(spark: SparkSession, path: str):
    """(file system, path object) of any store that Spark knows."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = hadoop_path(spark, path)
    return bool(fs.exists(p))


def read_table(spark: SparkSession, path: str, columns: Sequence[str] | None = None) -> DataFrame:
    """Batch Parquet scan with partition discovery; columns prunes the scan."""
    df = spark.read.parquet(resolve_path(path))
    return df.select(*columns) if columns else df


def read_if_exists(spark: SparkSession, path: str) -> DataFrame | None:
    """None only where nothing is there; a table that can't be read raises."""
    return read_table(spark, path) if exists(spark, resolve_path(path)) else None


def write_table(df: DataFrame, path: str, partition_by: Sequence[str] = (), mode: str = "overwrite", compression: str = "snappy") -> str:
    target = resolve_path(path)
    writer = df.write.mode(mode).option("compression", compression)
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(target)
    return target


def table_stats(spark: SparkSession, path: str, partition_col: str | None = None) -> dict:
    """Read-back check: rows, and distinct partitions."""
    df = read_table(spark, path)
    aggs = [F.count(F.lit(1)).alias("rows")]
    if partition_col:
        aggs.append(F.countDistinct(partition_col).alias("partitions"))
    return df.agg(*aggs).first().asDict()


def month_range(spark: SparkSession, start: str, end: str, limit: int | None = None) -> DataFrame:
    """Months from start to end ("YYYY-MM", both included): columns pos, month."""
    first, last = F.to_date(F.lit(f"{start}-01")), F.to_date(F.lit(f"{end}-01"))
    months = F.when(first <= last, F.sequence(first, last, F.expr("interval 1 month"))).otherwise(F.array().cast("array<date>"))
    df = spark.range(1).select(F.posexplode(months).alias("pos", "day")).select("pos", F.date_format("day", "yyyy-MM").alias("month"))
    return df.where(F.col("pos") < limit) if limit is not None else df


def download_file(url: str, dest: str, force: bool = False, chunk: int = 1 << 20) -> bool:
    """Stream to <dest>.part, then replace. False where the file was there already."""
    if os.path.exists(dest) and not force:
        return False
    Path(dest).parent.mkdir(parents=True, exist_ok=True)
    part = f"{dest}.part"
    with urllib.request.urlopen(url) as src, open(part, "wb") as out:
        shutil.copyfileobj(src, out, chunk)
    os.replace(part, dest)
    return True
