"""The per-minute event report over a stream of the event log."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery


def events_per_minute(events: DataFrame, lateness: str = "10 minutes") -> DataFrame:
    """Tumbling one-minute counts per agent; works on a stream and on a batch.

    The watermark bounds the state to the open minutes, however many events a run sends. Streams need
    a ``TIMESTAMP`` event time, so the zone-less column is read in the session time zone.
    """
    timed = events.select(F.col("ts").cast("timestamp").alias("ts"), "agent")
    return (
        timed.withWatermark("ts", lateness)
        .groupBy(F.window("ts", "1 minute"), "agent")
        .agg(F.count("*").alias("events"))
        .select(F.col("window.start").cast("timestamp_ntz").alias("minute"), "agent", "events")
    )


def write_per_minute(counts: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append finished minutes to parquet; the checkpoint folder must be on shared storage."""
    return (
        counts.writeStream.outputMode("append")
        .format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
