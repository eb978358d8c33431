"""Held-out rows replayed as a stream into stored facts.

Rows that the first load left out lie in files, a folder per day. They are delivered to
an inbox in the order of their days, as many at a time as the pace allows, and a file
stream loads what has come into the fact. A batch is named after its stream and number,
so one that is tried again after a failure replaces what the first try left.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.sources.shared import move_folder, subfolders
from tidemark.sources.spans import SpanFact
from tidemark.streaming.loads import file_stream

DAY = "__day"


def hold_out(rows: DataFrame, ts: str, folder: str) -> None:
    """Writes rows to a folder per day."""
    rows.withColumn(DAY, F.col(ts).cast("date")).hint("rebalance", DAY).write.partitionBy(DAY).parquet(folder)


def days_held(spark: SparkSession, folder: str) -> list[str]:
    """Days that wait for delivery, in order: a name each, no data."""
    return [n for n in subfolders(spark, folder) if n.startswith(f"{DAY}=")]


def deliver(spark: SparkSession, folder: str, inbox: str, days: int) -> list[str]:
    """Moves the first `days` folders that wait to the inbox, in order. A move is one rename:
    a day is there or waits, and a call after a failure goes on with the next."""
    moved = days_held(spark, folder)[:days]
    for name in moved:
        move_folder(spark, f"{folder}/{name}", f"{inbox}/{name}")
    return moved


def batch_name(checkpoint: str, batch_id: int) -> str:
    return f"stream_{hashlib.md5(checkpoint.rstrip('/').encode()).hexdigest()[:12]}_{batch_id}"


def replay(spark: SparkSession, inbox: str, schema: str, fact: SpanFact, checkpoint: str, files_per_batch: int = 100,
           every: str | None = None, loaded: Callable[[int], None] | None = None) -> StreamingQuery:
    """Loads what has come to the inbox into the fact. Without `every` the stream ends when it
    has loaded all that is there; with it, it looks again after each such time until it is
    stopped. `loaded` is called after a batch is stored and before it is committed."""
    def on_batch(rows: DataFrame, batch_id: int) -> None:
        fact.upsert(rows.drop(DAY), batch_name(checkpoint, batch_id))
        if loaded:
            loaded(batch_id)

    stream = file_stream(spark, inbox, f"{schema}, {DAY} date", files_per_batch)
    pace = {"processingTime": every} if every else {"availableNow": True}
    return stream.writeStream.foreachBatch(on_batch).option("checkpointLocation", checkpoint).trigger(**pace).start()
