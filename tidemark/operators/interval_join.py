"""Joins of points in time with spans."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def _bin(ts: str | Column, seconds: int) -> Column:
    c = F.col(ts) if isinstance(ts, str) else ts
    return F.floor(F.timestamp_diff("SECOND", F.lit("1970-01-01").cast("timestamp_ntz"), c) / seconds).cast("bigint")


def interval_join(points: DataFrame, spans: DataFrame, keys: list[str], at: str, start: str, end: str,
                  bin_seconds: int, closed: bool = False) -> DataFrame:
    """Each point with every span of the same keys that holds it.

    Time is cut into bins which become a join key: a span is repeated for the
    bins it touches, a point lies in one. So points meet only the spans near
    them, also where one key holds most rows, and no pair is found twice. Choose
    bins about as long as a usual span. `closed` takes in a span's end.
    """
    inside = (F.col(at) >= F.col(start)) & ((F.col(at) <= F.col(end)) if closed else (F.col(at) < F.col(end)))
    touched = F.sequence(_bin(start, bin_seconds), F.greatest(_bin(start, bin_seconds), _bin(end, bin_seconds)))
    spread = spans.withColumn("_bin", F.explode(touched))
    own = points.select([F.col(c).alias(f"_p_{c}") if c in keys else F.col(c) for c in points.columns] + [_bin(at, bin_seconds).alias("_p_bin")])
    on = F.col("_p_bin") == F.col("_bin")
    for k in keys:
        on = on & (F.col(f"_p_{k}") == F.col(k))
    return own.join(spread, on & inside).drop("_p_bin", "_bin", *[f"_p_{k}" for k in keys])
