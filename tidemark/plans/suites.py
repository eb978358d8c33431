"""All registered queries, bound to the tables each suite reads."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from weakref import WeakKeyDictionary

from pyspark.sql import DataFrame, SparkSession

from tidemark.plans import baselines, jobs, micro, monitor_archive, retail, runs, telemetry, tpcds, tpch
from tidemark.sources.tables import colocated_tables, monitor_tables, retail_tables, tpcds_tables, tpch_tables


_opened: WeakKeyDictionary = WeakKeyDictionary()


def opened(tables: Callable, spark: SparkSession, folder: str) -> Mapping[str, DataFrame]:
    """A suite's tables, opened once per session and folder: their files are
    listed once, as for a table of the catalog."""
    mine = _opened.setdefault(spark, {})
    if (tables, folder) not in mine:
        mine[tables, folder] = tables(spark, folder)
    return mine[tables, folder]


def bind(query: Callable, tables: Callable) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return query(opened(tables, spark, folder))

    run.__name__, run.__doc__ = query.__name__, query.__doc__
    return run


def registered() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    out: dict[str, Callable] = {}
    out |= {n: bind(q, tpch_tables) for n, q in tpch.QUERIES.items()}
    out |= {n: bind(q, colocated_tables if n in micro.COLOCATED else tpch_tables) for n, q in micro.QUERIES.items()}
    out |= {n: bind(q, retail_tables) for n, q in retail.QUERIES.items()}
    out |= {n: bind(q, tpcds_tables) for n, q in tpcds.QUERIES.items()}
    out |= {n: bind(q, monitor_tables) for n, q in runs.QUERIES.items()}
    out |= {n: bind(q, monitor_tables) for n, q in telemetry.QUERIES.items()}
    out |= {n: bind(q, monitor_tables) for n, q in baselines.QUERIES.items()}
    out |= {n: bind(q, monitor_tables) for n, q in monitor_archive.QUERIES.items()}
    out |= jobs.QUERIES
    return out
