"""Structured Streaming: gated micro-batches and event-time windows."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def gated_append(stream: DataFrame, path: str, checkpoint: str, gate: Callable[[DataFrame], object], partition_by: Sequence[str] = (), **trigger) -> StreamingQuery:
    """Append each micro-batch that passes the gate. Each goes to its own batch folder, overwritten on a replay,
    so a batch that is run twice is written once."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            if batch.isEmpty():
                return
            gate(batch)
            w = batch.write.mode("overwrite")
            (w.partitionBy(*partition_by) if partition_by else w).parquet(f"{path.rstrip('/')}/batch={batch_id}")
        finally:
            batch.unpersist()

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()


def tumbling_counts(stream: DataFrame, ts_col: str, keys: Sequence[str], width: str = "1 hour", late: str = "2 hours") -> DataFrame:
    """Counts by key and window; state older than the watermark is dropped. Works on batch frames too."""
    marked = stream.withWatermark(ts_col, late) if stream.isStreaming else stream
    out = marked.groupBy(F.window(ts_col, width).alias("_w"), *keys).agg(F.count(F.lit(1)).alias("n"))
    return out.select(F.col("_w.start").alias("window_start"), *keys, "n")
