"""Intermediate tables in the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def stored(df: DataFrame, folder: str) -> DataFrame:
    """The frame written as Parquet and opened again: later plans read it from
    there, whatever happens to executors."""
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def removed(spark: SparkSession, *folders: str) -> None:
    """Deletes tables whose last reader has written its own result."""
    for folder in folders:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(path, True)
