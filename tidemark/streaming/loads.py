"""Continuous loads on Structured Streaming.

A batch is written to a folder named after its stream and its id, and replaces what an
earlier, failed try of the same batch left there, so every row lands exactly once. A
stream is known by its checkpoint: a new checkpoint is another stream, whose batches stand
beside those of the first.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.sources.load import RAW, Delimited, PIPE, stage


def file_stream(spark: SparkSession, folder: str, schema: str, files_per_batch: int = 100, name_filter: str | None = None) -> DataFrame:
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch)
    if name_filter:
        reader = reader.option("pathGlobFilter", name_filter)
    return reader.parquet(folder)


def delimited_stream(spark: SparkSession, folder: str, schema: str, fmt: Delimited = PIPE, files_per_batch: int = 100) -> DataFrame:
    rows = spark.readStream.schema(f"{schema}, {RAW} string").options(**fmt.options()).option("maxFilesPerTrigger", files_per_batch).csv(folder)
    return rows.withColumn("_file", F.col("_metadata.file_path"))


def run_to_end(stream: DataFrame, on_batch: Callable[[DataFrame, int], None], checkpoint: str) -> None:
    """Processes what is there, batch by batch, and returns."""
    query = stream.writeStream.foreachBatch(on_batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()


def _place(target: str, kind: str, checkpoint: str, batch_id: int) -> str:
    stream = hashlib.md5(checkpoint.rstrip("/").encode()).hexdigest()[:12]
    return f"{target}/{kind}/stream={stream}/batch={batch_id}"


def append_batches(stream: DataFrame, target: str, checkpoint: str) -> None:
    """Appends every batch and keeps its row count beside it."""
    def on_batch(rows: DataFrame, batch_id: int) -> None:
        out = _place(target, "rows", checkpoint, batch_id)
        rows.write.mode("overwrite").parquet(out)
        counted = rows.sparkSession.read.parquet(out).agg(F.count("*").alias("rows"))
        counted.write.mode("overwrite").parquet(_place(target, "counts", checkpoint, batch_id))

    run_to_end(stream, on_batch, checkpoint)


def running_counts(spark: SparkSession, target: str) -> DataFrame:
    """Rows of each batch and of all batches so far. One row per batch."""
    from pyspark.sql import Window as W

    counts = spark.read.parquet(f"{target}/counts")
    return counts.withColumn("running", F.sum("rows").over(W.orderBy("stream", "batch").rowsBetween(W.unboundedPreceding, W.currentRow)))


def load_batches(stream: DataFrame, target: str, checkpoint: str, limit_percent: float | None = None) -> None:
    """Loads delimited batches: good rows, and rejected lines (REJECTS) apart. A batch is read
    once, to a folder whose parts are then renamed; one over the limit stops the stream
    before anything of it is in its place."""
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in stream.schema.fields if f.name not in (RAW, "_file"))

    def on_batch(rows: DataFrame, batch_id: int) -> None:
        staged = stage(rows, schema, _place(target, "staged", checkpoint, batch_id))
        staged.enforce(limit_percent=limit_percent)
        staged.move(False, _place(target, "rows", checkpoint, batch_id))
        staged.move(True, _place(target, "rejects", checkpoint, batch_id))
        staged.remove()

    run_to_end(stream, on_batch, checkpoint)
