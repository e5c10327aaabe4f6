"""Staged table replacement on any Hadoop file system.

A new version is written beside the table and swapped in by rename. Readers that come between
the two renames find no table for that instant; object stores copy instead of renaming.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from ambermill.sources.tables import hadoop_path

MARKER = "_SUCCESS"  # written at promotion only, so it marks a table that is whole


class TableWriter:
    def __init__(self, spark: SparkSession, stale_after_s: float = 6 * 3600.0) -> None:
        self.spark, self.stale_after_s = spark, stale_after_s

    def staging_path(self, table: str, run_id: str) -> str:
        return f"{table.rstrip('/')}.staging/{run_id}"

    def trash_path(self, table: str) -> str:
        return f"{table.rstrip('/')}.trash"

    def stage(self, df: DataFrame, table: str, partition_by: Sequence[str] = (), run_id: str | None = None, compression: str = "snappy") -> str:
        """Write to the staging folder; the table is untouched."""
        self._drop_stale(table)
        staged = self.staging_path(table, run_id or uuid.uuid4().hex)
        writer = df.write.mode("overwrite").option("compression", compression)
        writer = writer.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false")
        (writer.partitionBy(*partition_by) if partition_by else writer).parquet(staged)
        return staged

    def promote(self, staged: str, table: str) -> int:
        """Swap the staged version in; returns the number of partition folders, 1 at least."""
        fs, src = hadoop_path(self.spark, staged)
        _, final = hadoop_path(self.spark, table)
        _, trash = hadoop_path(self.spark, self.trash_path(table))
        if not fs.exists(src):
            raise FileNotFoundError(f"nothing is staged at {staged}")
        if fs.exists(trash):
            if fs.exists(final):
                fs.delete(trash, True)
            else:  # an earlier run stopped between its renames
                self._rename(fs, trash, final)
        had_old = fs.exists(final)
        if had_old:
            self._rename(fs, final, trash)
        moved = False
        try:
            fs.mkdirs(final.getParent())
            self._rename(fs, src, final)
            moved = True
            fs.create(self._child(final, MARKER), True).close()
        except Exception:
            self._rollback(fs, final, trash, moved, had_old)
            raise
        fs.delete(trash, True)
        self._remove_if_empty(fs, src.getParent())
        return max(1, sum(1 for s in fs.listStatus(final) if s.isDirectory() and "=" in s.getPath().getName()))

    def replace(self, df: DataFrame, table: str, partition_by: Sequence[str] = (), run_id: str | None = None) -> int:
        return self.promote(self.stage(df, table, partition_by, run_id), table)

    def is_complete(self, table: str) -> bool:
        """Whether the table was promoted whole; readers that need the guarantee ask first."""
        fs, final = hadoop_path(self.spark, table)
        return bool(fs.exists(self._child(final, MARKER)))

    def _child(self, parent, name: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(parent, name)

    def _rename(self, fs, src, dst) -> None:
        if fs.exists(dst):  # Hadoop would nest src inside it
            raise FileExistsError(str(dst))
        if not fs.rename(src, dst):
            raise OSError(f"could not rename {src} to {dst}")

    def _rollback(self, fs, final, trash, moved: bool, had_old: bool) -> None:
        """Take back what this promotion did. A table that another writer put there meanwhile stays, and the old one stays beside it."""
        if moved:
            fs.delete(final, True)
        if had_old and fs.exists(trash) and not fs.exists(final):
            self._rename(fs, trash, final)

    def _remove_if_empty(self, fs, folder) -> None:
        if fs.exists(folder) and not fs.listStatus(folder):
            fs.delete(folder, False)

    def _drop_stale(self, table: str) -> None:
        """Forget staging folders older than the limit; those of runs that may still be at work stay."""
        fs, root = hadoop_path(self.spark, f"{table.rstrip('/')}.staging")
        if not fs.exists(root):
            return
        oldest = (time.time() - self.stale_after_s) * 1000
        for s in fs.listStatus(root):
            if s.getModificationTime() < oldest:
                fs.delete(s.getPath(), True)
        self._remove_if_empty(fs, root)
