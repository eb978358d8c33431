"""Ranks over whole frames without gathering them in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window as W, functions as F


def spread_rank(df: DataFrame, value: str, name: str, keys: list[str], buckets: int = 256) -> DataFrame:
    """rank() over (partition by keys order by value nulls last), for groups too large
    for one task. Keys may be null and values must be numbers or null.

    Equal values are counted first, so ties of any number are one row. Values then fall
    into buckets between the group's approximate quantiles, so that an outlier does not
    crowd the others into one; a rank is the count of all rows in lower buckets plus the
    running count in the own one.
    """
    group = [f"_k{i}" for i in range(len(keys))]
    keyed = df.select(*[F.col(k).alias(g) for k, g in zip(keys, group)], F.col(value).alias("_v"))
    counts = keyed.groupBy(*group, "_v").agg(F.count("*").alias("_n"))
    cuts = [i / buckets for i in range(1, buckets)]
    ends = counts.groupBy(*group).agg(F.percentile_approx("_v", F.array(*[F.lit(c) for c in cuts]), F.lit(10_000)).alias("_cuts"))
    same = lambda names, other: [F.col(n).eqNullSafe(F.col(f"{other}{n}")) for n in names]
    renamed = lambda frame, names, other: frame.select(*[F.col(c).alias(f"{other}{c}" if c in names else c) for c in frame.columns])
    # Nulls stand in a bucket of their own, after all others.
    bucket = F.when(F.col("_v").isNull(), F.lit(buckets)).otherwise(F.size(F.filter("_cuts", lambda c: c < F.col("_v"))))
    placed = counts.join(renamed(ends, group, "e"), same(group, "e")).withColumn("_b", bucket).select(*group, "_v", "_n", "_b")
    below = W.partitionBy(*group).orderBy("_b").rowsBetween(W.unboundedPreceding, -1)
    sizes = placed.groupBy(*group, "_b").agg(F.sum("_n").alias("_size"))  # at most `buckets` + 1 rows per group
    starts = sizes.select(*group, "_b", F.coalesce(F.sum("_size").over(below), F.lit(0)).alias("_start"))
    inside = W.partitionBy(*group, "_b").orderBy("_v").rowsBetween(W.unboundedPreceding, -1)
    ranked = placed.withColumn("_before", F.coalesce(F.sum("_n").over(inside), F.lit(0))).join(
        renamed(starts, [*group, "_b"], "s"), same([*group, "_b"], "s"))
    ranks = ranked.select(*group, "_v", (F.col("_start") + F.col("_before") + 1).alias(name))
    on = [F.col(k).eqNullSafe(F.col(g)) for k, g in zip([*keys, value], [*group, "_v"])]
    return df.join(ranks, on).drop(*group, "_v")
