"""Session settings the suites are written for."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # One key may hold a third of the rows of a join side: let AQE split it.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # Semi and anti joins on facts profit from a bloom filter on the scan.
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    # HotSpot leaves methods over 8000 bytes uncompiled. A stage whose generated code is
    # that long runs faster as separate operators.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.sql.cbo.enabled": "true",
    "spark.sql.cbo.joinReorder.enabled": "true",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None, **extra: str) -> SparkSession:
    """Session for the suites. On a cluster pass neither argument: master and
    shuffle width then come from spark-submit."""
    builder = SparkSession.builder.appName("tidemark")
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
