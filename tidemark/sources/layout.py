"""Table writing: format, compression, partitioning, distribution, statistics."""

from __future__ import annotations

import math
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame, SparkSession, functions as F

OVERWRITE_MODE = "spark.sql.sources.partitionOverwriteMode"
ALL_KEYS = "spark.sql.requireAllClusterKeysForCoPartition"

# Storage names of the old engine and what they map to.
FORMATS = {"PARQUET": "parquet", "COLUMN": "orc", "ROW": "csv"}
CODECS = {"QUICKLZ": "snappy", "SNAPPY": "snappy", "ZLIB": "gzip", "GZIP": "gzip", "ZSTD": "zstd", "NONE": "none"}
ORC_CODECS = {"gzip": "zlib"}
FIRST_DAY, LAST_DAY = "1992-01-01", "1998-12-31"
#: Stored bytes of a bucket or file, and buckets or files of a table at most.
PART_BYTES, MOST_PARTS = 128 << 20, 1 << 16


@dataclass(frozen=True)
class Layout:
    """How a table lies on storage.

    orientation: PARQUET, COLUMN (ORC) or ROW (CSV).
    partition_by: columns holding few values, one folder each.
    bucket_by, buckets: key distribution; rows of one key share a bucket, so a
    join or group on the key needs no exchange.
    random_files: spread rows round-robin over so many files instead.
    """

    orientation: str = "PARQUET"
    codec: str = "SNAPPY"
    row_group: int = 8 * 1024 * 1024
    page: int = 1024 * 1024
    partition_by: tuple[str, ...] = ()
    bucket_by: tuple[str, ...] = ()
    buckets: int = 0
    random_files: int = 0
    sort_by: tuple[str, ...] = ()
    options: dict = field(default_factory=dict)


def stored_bytes(df: DataFrame) -> int:
    """Bytes of a frame as the optimizer knows them: those of its files, for a scan."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def parts_for(*frames: DataFrame, part_bytes: int = PART_BYTES) -> int:
    """Buckets or files for frames that are laid out alike, from the bytes of the largest: a
    power of two, so that numbers chosen for different tables divide each other, and no
    less than the cores at hand."""
    wanted = max(max(stored_bytes(f) for f in frames) / part_bytes, frames[0].sparkSession.sparkContext.defaultParallelism, 1)
    return min(MOST_PARTS, 1 << (math.ceil(wanted) - 1).bit_length())


def _arranged(df: DataFrame, layout: Layout) -> DataFrame:
    if layout.random_files:
        return df.repartition(layout.random_files)
    if layout.bucket_by:
        # One shuffle to the table's own distribution gives one file per bucket.
        return df.repartition(layout.buckets, *layout.bucket_by)
    if layout.partition_by:
        # Rebalance gathers each folder's rows but splits a folder that is too big for one task.
        return df.hint("rebalance", *layout.partition_by)
    return df


def _layout_of(spark: SparkSession, table: str, layout: Layout) -> Layout:
    """`layout` with the partitioning and bucketing that the stored table has."""
    columns = spark.catalog.listColumns(table)
    parts = tuple(c.name for c in columns if c.isPartition)
    bucketed = tuple(c.name for c in columns if c.isBucket)
    described = {r.col_name: r.data_type for r in spark.sql(f"describe extended {table}").collect()}
    buckets = int(described.get("Num Buckets", "0") or 0)
    return replace(layout, partition_by=parts, bucket_by=bucketed if buckets > 0 else (), buckets=max(buckets, 0))


def _writer(df: DataFrame, layout: Layout, mode: str):
    kind = FORMATS[layout.orientation.upper()]
    codec = CODECS[layout.codec.upper()]
    if kind == "orc":
        codec = ORC_CODECS.get(codec, codec)
    w = _arranged(df, layout).write.mode(mode).format(kind).option("compression", codec).options(**layout.options)
    if kind == "parquet":
        w = w.option("parquet.block.size", layout.row_group).option("parquet.page.size", layout.page)
    if layout.partition_by:
        w = w.partitionBy(*layout.partition_by)
    if layout.bucket_by:
        w = w.bucketBy(layout.buckets, *layout.bucket_by)
        if layout.sort_by:
            w = w.sortBy(*layout.sort_by)
    return w


def write_table(df: DataFrame, table: str, layout: Layout = Layout(), mode: str = "overwrite", path: str | None = None) -> None:
    """Create-table-as-select (overwrite) or insert-select (append)."""
    if mode == "append" and df.sparkSession.catalog.tableExists(table):
        # Appended rows are laid out as the table's own are.
        spark = df.sparkSession
        _arranged(df.select(*spark.table(table).columns), _layout_of(spark, table, layout)).write.insertInto(table)
        return
    writer = _writer(df, layout, mode)
    (writer.option("path", path) if path else writer).saveAsTable(table)


@contextmanager
def only_written_folders(spark: SparkSession) -> Iterator[None]:
    """An overwrite replaces the partitions it has rows for, and no others."""
    before = spark.conf.get(OVERWRITE_MODE)
    spark.conf.set(OVERWRITE_MODE, "dynamic")
    try:
        yield
    finally:
        spark.conf.set(OVERWRITE_MODE, before)


@contextmanager
def joins_by_some_keys(spark: SparkSession) -> Iterator[None]:
    """A join takes its sides as they lie where both are dealt by the same part of its keys."""
    before = spark.conf.get(ALL_KEYS)
    spark.conf.set(ALL_KEYS, "false")
    try:
        yield
    finally:
        spark.conf.set(ALL_KEYS, before)


def replace_partitions(rows: DataFrame, table: str, *gather: str) -> None:
    """Replaces the partitions of a stored table that `rows` has rows for; the rows of each
    are gathered by the columns `gather`. The table may be one that `rows` reads."""
    spark = rows.sparkSession
    with only_written_folders(spark):
        rows.select(*spark.table(table).columns).hint("rebalance", *gather).write.mode("overwrite").insertInto(table)


def write_files(df: DataFrame, path: str, layout: Layout = Layout(), mode: str = "overwrite") -> None:
    if layout.bucket_by:
        raise ValueError("bucketing needs a table; use write_table")
    _writer(df, layout, mode).save(path)


def slice_of(day: str, slices: int, first: str = FIRST_DAY, last: str = LAST_DAY):
    """Number of the equal date slice a day falls in; days outside go to the ends."""
    span = f"(datediff(date '{last}', date '{first}') + 1)"
    raw = f"cast(floor(datediff({day}, date '{first}') * {slices} / {span}) as int)"
    return F.expr(f"greatest(0, least({slices - 1}, {raw}))")


def width_slice(day: str, days: int, first: str = FIRST_DAY):
    """Number of the slice of `days` days, counted from the first day."""
    return F.expr(f"cast(floor(datediff({day}, date '{first}') / {days}) as int)")


def month_of(ts: str):
    """Month number yyyymm: the partition column of the mixed-grain facts."""
    return F.expr(f"year({ts}) * 100 + month({ts})")


def within_months(column: str, start: str, end: str):
    """Partition predicate for a timestamp range, so a scan touches its months only."""
    return F.expr(f"{column} between year(timestamp '{start}') * 100 + month(timestamp '{start}') "
                  f"and year(timestamp '{end}') * 100 + month(timestamp '{end}')")


def analyze(spark: SparkSession, table: str, *columns: str, bins: int = 0) -> None:
    """Statistics for the cost-based optimizer: least, greatest and number of distinct
    values per column, and with `bins` a histogram of so many parts of equal height of each
    column with an order, which tells it how many rows a range of a skewed column holds."""
    cols = f"for columns {', '.join(columns)}" if columns else "for all columns"
    settings = {"spark.sql.statistics.histogram.enabled": "true", "spark.sql.statistics.histogram.numBins": str(bins)} if bins else {}
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        spark.sql(f"analyze table {table} compute statistics {cols}")
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def literal_table(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A small dimension given as literal rows."""
    return spark.createDataFrame(rows, schema)


def move_to_history(spark: SparkSession, table: str, history: str, run: str, first: int, last: int, batch_id: str) -> None:
    """Moves the rows of runs `first` to `last` into the history table.

    `table` is partitioned by the column `run`; rows of one run no longer change. The
    history is partitioned by batch_id and run. The caller names the batch: a rerun under
    the same name, after a failure at any point, replaces what the first try has written of
    the runs that are still in the source, and leaves those already moved; another name adds rows, also if they are equal to those of an earlier batch. Of the
    source only the moved runs' partitions are emptied, so other runs may be loaded
    meanwhile.
    """
    rows = spark.table(table).filter(F.col(run).between(first, last))
    runs = [r[0] for r in rows.select(run).distinct().collect()]  # partitions, not rows
    if not runs:
        return
    moved = rows.withColumn("batch_id", F.lit(batch_id))
    if spark.catalog.tableExists(history):
        replace_partitions(moved, history, run)
    else:
        columns = [c for c in rows.columns if c != run] + ["batch_id", run]
        write_table(moved.select(*columns), history, Layout(partition_by=("batch_id", run)))
    none = f"{table.replace('.', '_')}_no_rows"
    spark.createDataFrame([], spark.table(table).drop(run).schema).createOrReplaceTempView(none)
    for value in runs:
        spark.sql(f"insert overwrite table {table} partition ({run} = {value}) select * from {none}")
    spark.catalog.dropTempView(none)
