"""Surrogate keys over whole frames."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window as W, functions as F

from tidemark.sources.shared import settle

ROW_BITS = 33  # of monotonically_increasing_id: the number within a partition


def dense_ids(df: DataFrame, name: str, order: list[str], start: int = 1) -> DataFrame:
    """Numbers rows start, start + 1, ... in the order of unique columns.

    A distributed sort fixes the order; partition counts give each partition its
    offset. The sorted frame is settled first, as partitions and their numbering
    must be the same in both reads.
    """
    rows = settle(df.orderBy(*order).withColumn("_m", F.monotonically_increasing_id()))
    part = F.shiftright("_m", ROW_BITS)
    counts = rows.groupBy(part.alias("_p")).agg(F.count("*").alias("_n"))  # one row per partition
    before = F.sum("_n").over(W.orderBy("_p").rowsBetween(W.unboundedPreceding, -1))
    offsets = counts.select("_p", F.coalesce(before, F.lit(0)).alias("_before"))
    numbered = rows.withColumn("_p", part).join(F.broadcast(offsets), "_p")
    number = F.col("_before") + F.col("_m").bitwiseAND(F.lit((1 << ROW_BITS) - 1)) + F.lit(start)
    return numbered.withColumn(name, number).drop("_m", "_p", "_before")


def gapped_ids(df: DataFrame, name: str, start: int = 1) -> DataFrame:
    """Unique numbers with gaps and no extra pass. They depend on partitioning."""
    return df.withColumn(name, F.monotonically_increasing_id() + F.lit(start))
