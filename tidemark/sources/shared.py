"""The folder for intermediate tables and checkpoints."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SETTING = "spark.checkpoint.dir"


def shared_root(spark: SparkSession) -> str:
    """The shared folder the cluster names. Only where none is named, as in
    tests on one machine, a temporary folder is made and set."""
    root = spark.conf.get(SETTING, None) or spark.sparkContext.getConf().get(SETTING)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError(f"set {SETTING} to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="tidemark-")
        spark.conf.set(SETTING, root)
    return root.rstrip("/")


def new_folder(spark: SparkSession, name: str) -> str:
    """A fresh, unused path below the shared folder."""
    return f"{shared_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def use_checkpoints(spark: SparkSession) -> None:
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_root(spark))


def settle(df: DataFrame) -> DataFrame:
    """The frame written once to the shared folder, so that later plans read it
    from there: its lineage ends and a lost executor costs nothing."""
    use_checkpoints(df.sparkSession)
    return df.checkpoint()


def _files(spark: SparkSession, folder: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), path


def folder_exists(spark: SparkSession, folder: str) -> bool:
    fs, path = _files(spark, folder)
    return fs.exists(path)


def subfolders(spark: SparkSession, folder: str) -> list[str]:
    """Names of what lies in a folder, in order; none if it is not there."""
    fs, path = _files(spark, folder)
    return sorted(s.getPath().getName() for s in fs.listStatus(path)) if fs.exists(path) else []


def make_folder(spark: SparkSession, folder: str) -> None:
    fs, path = _files(spark, folder)
    fs.mkdirs(path)


def move_folder(spark: SparkSession, source: str, target: str) -> None:
    """Renames a folder to a path that is free. Folders above the target are made."""
    fs, path = _files(spark, target)
    fs.mkdirs(path.getParent())
    if fs.exists(path) or not fs.rename(_files(spark, source)[1], path):
        raise OSError(f"{source} could not be moved to {target}")


def remove_folder(spark: SparkSession, folder: str) -> None:
    fs, path = _files(spark, folder)
    fs.delete(path, True)
