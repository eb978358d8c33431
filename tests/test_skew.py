"""Queries on data where one part, supplier, customer or user holds a third of the rows."""

import shutil
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry
from check import compare, open_duckdb
from conftest import DATA

CHANGED = {
    "lineitem": "* replace (if(hash(l_orderkey, l_extendedprice) % 3 = 0, 3, l_partkey) as l_partkey, "
                "if(hash(l_orderkey, l_extendedprice) % 3 = 1, 7, l_suppkey) as l_suppkey)",
    "orders": "* replace (if(o_orderkey % 3 = 1, 9, o_custkey) as o_custkey)",
    "events": "* replace (if(event_id % 3 = 1, 1, user_id) as user_id)",
}
NAMES = [
    "tpch_q09", "tpch_q13", "tpch_q17", "tpch_q18", "tpch_q20", "tpch_q21", "micro_x11", "retail_r566", "retail_r592", "retail_r594_open",
    "retail_r596", "retail_r603", "runs_summary", "telemetry_query_usage", "telemetry_segment_statistics", "stream_spans",
    "tpcds_q01", "tpcds_q38", "tpcds_q44", "tpcds_q49", "tpcds_q51", "tpcds_q65", "tpcds_q67", "tpcds_q72", "tpcds_q97",
]


@pytest.fixture(scope="module")
def skewed(tmp_path_factory):
    folder = tmp_path_factory.mktemp("skewed")
    for path in Path(DATA).glob("*.parquet"):
        name, target = path.stem, folder / path.name
        if name in CHANGED:
            duckdb.sql(f"copy (select {CHANGED[name]} from '{path}') to '{target}' (format parquet)")
        else:
            shutil.copy(path, target)
    return str(folder), open_duckdb(str(folder))


@pytest.mark.parametrize("name", NAMES)
def test_query_with_hot_keys(spark, skewed, name):
    folder, con = skewed
    ok, note = compare(entry.queries()[name](spark, folder), con, entry.oracle_sql()[name])
    assert ok, note
