"""Delimited files into typed tables, with limits on rejected rows."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.sources.layout import Layout, write_files, write_table
from tidemark.sources.shared import folder_exists, move_folder, new_folder, remove_folder

RAW, BAD = "_rejected_line", "_bad"
#: What is kept of a rejected line.
REJECTS = f"_file string, {RAW} string"


@dataclass(frozen=True)
class Delimited:
    """A delimited text format. `null` is the text that stands for null."""

    sep: str = "|"
    null: str | None = None
    header: bool = False

    def options(self) -> dict[str, str]:
        out = {"sep": self.sep, "header": str(self.header).lower(), "mode": "PERMISSIVE", "columnNameOfCorruptRecord": RAW,
               "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]"}
        if self.null is not None:
            out["nullValue"] = self.null
        return out


PIPE = Delimited()
PIPE_NULLS = Delimited(null="")
CSV = Delimited(sep=",")


class RejectLimitExceeded(Exception):
    """Too many rows could not be read; nothing was loaded."""


def _raw(spark: SparkSession, path: str, schema: str, fmt: Delimited) -> DataFrame:
    return spark.read.schema(f"{schema}, {RAW} string").options(**fmt.options()).csv(path)


def read_delimited(spark: SparkSession, path: str, schema: str, fmt: Delimited = PIPE) -> DataFrame:
    """Typed rows; a line that does not fit keeps its text in the last column."""
    return judged(_raw(spark, path, schema, fmt))


def judged(rows: DataFrame) -> DataFrame:
    """Rows judged by all their fields. The reader converts only the columns a
    plan needs and would pass a bad field that is not among them; a condition
    over all columns, which always holds, makes it convert every one. A plan that
    writes all columns, as `stage` does, needs no such condition."""
    data = [c for c in rows.columns if c != RAW]
    return rows.withColumn("_file", F.col("_metadata.file_path")).filter(F.xxhash64(*data) >= F.lit(-(2**63)))


def accepted(rows: DataFrame) -> DataFrame:
    return rows.filter(F.col(RAW).isNull()).drop(RAW, "_file")


def rejected(rows: DataFrame) -> DataFrame:
    return rows.filter(F.col(RAW).isNotNull()).select(F.col("_file").alias("file"), F.col(RAW).alias("line"))


def reject_counts(rows: DataFrame) -> DataFrame:
    """Good and bad rows per file. Only a count leaves the scan, one row per file."""
    bad = F.col(RAW).isNotNull().cast("int")
    return rows.groupBy("_file").agg(F.sum(bad).alias("bad"), F.sum(1 - bad).alias("good"))


@dataclass(frozen=True)
class Staged:
    """Rows of an input that was read once: good and bad ones lie apart, of what number is known."""

    spark: SparkSession
    folder: str
    schema: str

    def _path(self, bad: bool) -> str:
        return f"{self.folder}/{BAD}={str(bad).lower()}"

    def _part(self, bad: bool, schema: str) -> DataFrame:
        path = self._path(bad)
        return self.spark.read.schema(schema).parquet(path) if folder_exists(self.spark, path) else self.spark.createDataFrame([], schema)

    def good(self) -> DataFrame:
        return self._part(False, self.schema)

    def bad(self) -> DataFrame:
        """(file, line) of each rejected row."""
        return self._part(True, REJECTS).select(F.col("_file").alias("file"), F.col(RAW).alias("line"))

    def enforce(self, limit_rows: int | None = None, limit_percent: float | None = None) -> None:
        """Raises, and removes the rows, if a file has `limit_rows` bad rows or more, or the whole
        input's share of bad rows exceeds `limit_percent`. Counts come from the files' own
        row counts, those per file from the bad rows."""
        if limit_rows is None and limit_percent is None:
            return
        bad = self.bad()
        worst = 0 if limit_rows is None else bad.groupBy("file").agg(F.count("*").alias("n")).agg(F.max("n")).first()[0] or 0
        try:
            _enforce(worst, bad.count(), self.good().count(), limit_rows, limit_percent)
        except RejectLimitExceeded:
            self.remove()
            raise

    def publish(self, table: str, path: str) -> None:
        """Makes the good rows a new table at a free path: the folder is renamed, nothing is
        copied, and the table is there when the catalogue has it."""
        if folder_exists(self.spark, self._path(False)):
            move_folder(self.spark, self._path(False), path)
        else:
            self.good().write.parquet(path)
        self.spark.sql(f"create table {table} ({self.schema}) using parquet location '{path}'")

    def move(self, bad: bool, path: str) -> None:
        """The good or bad rows' files at another path, in place of what is there."""
        remove_folder(self.spark, path)
        if folder_exists(self.spark, self._path(bad)):
            move_folder(self.spark, self._path(bad), path)
        else:
            self._part(bad, REJECTS if bad else self.schema).write.parquet(path)

    def remove(self) -> None:
        remove_folder(self.spark, self.folder)


def stage(rows: DataFrame, schema: str, folder: str) -> Staged:
    """Writes rows with their rejected lines (as the reader gives them) to a folder, the only
    time that the input is read. All columns are written, so all are parsed."""
    named = rows if "_file" in rows.columns else rows.withColumn("_file", F.col("_metadata.file_path"))
    flagged = named.withColumn(BAD, F.col(RAW).isNotNull()).withColumn("_file", F.when(F.col(BAD), F.col("_file")))
    flagged.write.mode("overwrite").partitionBy(BAD).parquet(folder)
    return Staged(rows.sparkSession, folder, schema)


def _enforce(worst: int, bad: int, good: int, limit_rows: int | None, limit_percent: float | None) -> None:
    if limit_rows is not None and worst >= limit_rows:
        raise RejectLimitExceeded(f"{worst} rejected rows in one file, limit {limit_rows}")
    if limit_percent is not None and bad and 100.0 * bad / (bad + good) > limit_percent:
        raise RejectLimitExceeded(f"{bad} of {bad + good} rows rejected, limit {limit_percent}%")


def enforce_limit(rows: DataFrame, limit_rows: int | None = None, limit_percent: float | None = None) -> None:
    """Raises if a file has `limit_rows` bad rows or more, or the whole input's
    share of bad rows exceeds `limit_percent`. For rows that are not loaded; reads them once."""
    counts = reject_counts(rows)
    worst = counts.agg(F.max("bad").alias("worst"), F.sum("bad").alias("bad"), F.sum("good").alias("good")).first()
    _enforce(worst["worst"] or 0, worst["bad"] or 0, worst["good"] or 0, limit_rows, limit_percent)


def load(spark: SparkSession, path: str, schema: str, table: str, fmt: Delimited = PIPE, layout: Layout = Layout(), mode: str = "append",
         limit_rows: int | None = None, limit_percent: float | None = None, error_table: str | None = None,
         table_path: str | None = None, error_path: str | None = None) -> None:
    """Bulk copy: good rows to the table and bad lines to the error table, if the limit allows.

    The input is read once and written to a folder beside the tables; only what is
    within the limit goes on. A new table of the plain layout with a path is that
    folder, renamed; other layouts and additions to a table are made from it.
    """
    staged = stage(_raw(spark, path, schema, fmt), schema, new_folder(spark, "staged"))
    staged.enforce(limit_rows, limit_percent)
    if error_table:
        write_table(staged.bad(), error_table, Layout(), mode, error_path)
    if layout == Layout() and table_path and not spark.catalog.tableExists(table) and not folder_exists(spark, table_path):
        staged.publish(table, table_path)
    else:
        write_table(staged.good(), table, layout, mode, table_path)
    staged.remove()


def unload(df: DataFrame, path: str, fmt: Delimited = PIPE) -> None:
    """Delimited text files of a frame."""
    write_files(df, path, Layout(orientation="ROW", codec="NONE", options={k: v for k, v in fmt.options().items() if k in ("sep", "header", "nullValue")}
                                 | {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss"}))
