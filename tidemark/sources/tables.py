"""Named tables, as the suites see them.

A suite takes any mapping from table name to DataFrame. `StoredTables` serves
tables as they lie on storage; `DerivedTables` adds those that are computed
from the stored TPC-H-like set.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.sources import derive, layout, star
from tidemark.sources.schemas import STORED
from tidemark.sources.shared import new_folder


class StoredTables(Mapping):
    """Parquet tables at <folder>/<name>.parquet, read with declared schemas."""

    def __init__(self, spark: SparkSession, folder: str, schemas: dict[str, str] = STORED):
        self.spark, self.folder, self.schemas = spark, folder.rstrip("/"), schemas
        self._open: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._open:
            reader = self.spark.read
            if name in self.schemas:
                reader = reader.schema(self.schemas[name])
            self._open[name] = reader.parquet(f"{self.folder}/{name}.parquet")
        return self._open[name]

    def __iter__(self):
        return iter(self.schemas)

    def __len__(self):
        return len(self.schemas)


def create_views(tables: Mapping, *names: str, prefix: str = "") -> None:
    """Temporary views of some tables, or of all, for use in SQL text."""
    for name in names or tuple(tables):
        tables[name].createOrReplaceTempView(prefix + name)


class DerivedTables(Mapping):
    """Stored tables plus one suite's derived ones, which shadow them by name."""

    def __init__(self, stored: Mapping, definitions: dict[str, derive.Derived], spark: SparkSession):
        self.stored, self.definitions, self.spark = stored, definitions, spark
        self._built: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self.definitions:
            return self.stored[name]
        if name not in self._built:
            self._built[name] = self._build(name)
        return self._built[name]

    def _build(self, name: str) -> DataFrame:
        d = self.definitions[name]
        if name == "partsupp":
            suppliers = self.stored["supplier"].agg(F.count("*").alias("n")).scalar()
            keyed = {**d.stages[0], "ps_suppkey": "p_partkey*7 + copy*13"}
            raw = derive.build(self.spark, self.stored["part"], derive.Derived(d.base, (keyed,), d.where, d.times))
            return raw.withColumn("ps_suppkey", F.col("ps_suppkey") % suppliers)
        base = None if d.base.startswith("range:") else self.stored[d.base]
        if any("@run_events" in v for stage in d.stages for v in stage.values()):
            half = self.stored["events"].agg((F.floor(F.max("event_id") / 2) + 1).alias("n")).scalar()
            base = base.withColumn("__run_events", half)
        return derive.build(self.spark, base, d)

    def __iter__(self):
        return iter({**dict.fromkeys(self.stored), **self.definitions})

    def __len__(self):
        return len(set(self.stored) | set(self.definitions))


class ColocatedTables(Mapping):
    """Base tables laid out by the keys they are joined on. The tables of a group have the
    same number of buckets, which follows from their bytes, so that joins and groupings on
    the key read them where they lie, without an exchange. A table is written
    when it is first asked for, and found by its name from then on; all others are passed on."""

    def __init__(self, tables: Mapping, groups: Sequence[Mapping[str, str]], spark: SparkSession):
        self.tables, self.groups, self.spark = tables, groups, spark
        self.folder = new_folder(spark, "colocated")
        self.names: dict[str, str] = {}

    def __getitem__(self, name: str) -> DataFrame:
        group = next((g for g in self.groups if name in g), None)
        if group is None:
            return self.tables[name]
        if name not in self.names:
            buckets, key = layout.parts_for(*[self.tables[n] for n in group]), group[name]
            self.names[name] = f"{self.folder.rsplit('/', 1)[1].replace('-', '_')}_{name}"
            how = layout.Layout(buckets=buckets, bucket_by=(key,), sort_by=(key,))
            layout.write_table(self.tables[name], self.names[name], how, path=f"{self.folder}/{name}")
        return self.spark.table(self.names[name])

    def __iter__(self):
        return iter(self.tables)

    def __len__(self):
        return len(self.tables)


#: Tables distributed by the key of an order.
BY_ORDER = {"lineitem": "l_orderkey", "orders": "o_orderkey"}


def colocated_tables(spark: SparkSession, folder: str) -> ColocatedTables:
    return ColocatedTables(tpch_tables(spark, folder), [BY_ORDER], spark)


def tpch_tables(spark: SparkSession, folder: str) -> DerivedTables:
    return DerivedTables(StoredTables(spark, folder), star.TPCH, spark)


def tpcds_tables(spark: SparkSession, folder: str) -> DerivedTables:
    named = {("customer" if k == "ds_customer" else k): v for k, v in star.TPCDS.items()}
    return DerivedTables(StoredTables(spark, folder), named, spark)


def retail_tables(spark: SparkSession, folder: str) -> DerivedTables:
    return DerivedTables(StoredTables(spark, folder), star.RETAIL, spark)


def monitor_tables(spark: SparkSession, folder: str) -> DerivedTables:
    return DerivedTables(StoredTables(spark, folder), star.MONITOR, spark)
