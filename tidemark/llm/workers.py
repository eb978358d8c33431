"""Python workers find this package."""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import SparkSession

ROOT = str(Path(__file__).resolve().parent.parent.parent)


def importable(spark: SparkSession) -> None:
    """Adds the folder that holds the package to the workers' module path, for a
    package that runs from its source folder. Where it is installed, or sent by
    spark.submit.pyFiles, this changes nothing."""
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(":") if p]
    if ROOT not in paths:
        env["PYTHONPATH"] = ":".join([*paths, ROOT])
