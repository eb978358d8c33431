"""Windowed telemetry and query spans as streams.

Samples up to ten minutes late count; later ones are dropped. Results appear
once the watermark has passed them, so state stays bounded. A run over a bounded input
ends with `close_input`, whose marker lets the watermark pass everything before it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

LATENESS = "10 minutes"


def telemetry_windows(samples: DataFrame, ts: str, host: str, value: str, length: str = "5 minutes", slide: str | None = None) -> DataFrame:
    """Peak, sum and count per host and tumbling or sliding window."""
    span = F.window(ts, length, slide) if slide else F.window(ts, length)
    out = samples.withWatermark(ts, LATENESS).groupBy(span.alias("w"), host).agg(
        F.max(value).alias("peak"), F.sum(F.col(value).cast("decimal(18,2)")).cast("double").alias("total"), F.count("*").alias("samples"))
    return out.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), host, "peak", "total", "samples")


def activity_spans(snapshots: DataFrame, ts: str, session: str, gap: str = "1 hour") -> DataFrame:
    """Spans of activity: a session that shows in no snapshot for `gap` has ended.

    The built-in session window keeps the state and closes it by watermark.
    """
    span = F.session_window(ts, gap)
    out = snapshots.withWatermark(ts, LATENESS).groupBy(span.alias("w"), session).agg(F.max(ts).alias("last_seen"), F.count("*").alias("snapshots"))
    return out.select(session, F.col("w.start").alias("started"), "last_seen", F.col("w.end").alias("ended"), "snapshots")


def close_input(rows: DataFrame, ts: str, folder: str, after: str = "1 year") -> None:
    """Adds a file with an end marker to a bounded input: one row, null but for a time
    well after all others. Read in a batch of its own, after the rest, it closes every
    window of the input; its own stays open and is never written."""
    end = rows.agg(F.max(ts).alias(ts)).select(*[(F.expr(f"{ts} + interval {after}") if c == ts else F.lit(None)).cast(rows.schema[c].dataType).alias(c) for c in rows.columns])
    end.filter(F.col(ts).isNotNull()).coalesce(1).write.mode("append").parquet(folder)


def to_files(stream: DataFrame, target: str, checkpoint: str) -> None:
    """Writes finished results to files, exactly once, and returns when the input is used up."""
    query = stream.writeStream.format("parquet").outputMode("append").option("path", target).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
