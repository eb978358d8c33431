"""Days that conditions on the calendar choose, and the ranges that reach the scans."""

import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from conftest import DATA
from tidemark.plans.tpcds import common
from tidemark.sources.tables import tpcds_tables

CONDITIONS = ["d_year = 1998", "d_year = 1998 and d_moy = 12", "d_year = 1999 and d_moy between 3 and 5", "d_year in (1997, 1999) and d_moy in (2, 11)", "d_moy = 11 and d_year = 2000",
              "d_year between 1996 and 1998", "d_qoy = 2 and d_year = 1998", "d_date between date '1998-02-27' and date_add(date '1998-02-27', 30)", "d_year = 1998 and d_qoy between 1 and 3",
              "d_date between date '1997-12-30' and date '1998-01-05'", "d_year = 1998 and d_dom between 1 and 3", "d_day_name = 'Monday' and d_year = 1997"]


@pytest.fixture(scope="module")
def tables(spark):
    return tpcds_tables(spark, DATA)


@pytest.mark.parametrize("where", CONDITIONS)
def test_a_span_holds_the_chosen_days(tables, where):
    first, last = common.span_of(where)
    days = tables["date_dim"].filter(where).agg(F.min("d_date"), F.max("d_date")).first()
    assert first <= days[0] and days[1] <= last
    if "d_dom" not in where and "day_name" not in where:
        assert (days[0] == first or first < dt.date(1992, 1, 1)) and days[1] == last


@pytest.mark.parametrize("where", ["d_year = 1998 or d_year = 2000", "d_moy = 11", "d_year = 1999 + 1", "d_year between 1998 and 1998 + 1", "d_month_seq between 1200 and 1211",
                                   "not d_year = 1998", "(d_year = 1998 and d_moy = 12) or d_moy = 1"])
def test_no_span_where_the_text_does_not_say_so(where):
    assert common.span_of(where) is None


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_ranges_reach_the_scan_without_a_subquery(tables):
    text = plan(common.sold(tables, "store_sales", "d_year = 1998 and d_moy = 12"))
    scan = next(x for x in text.split("\n") if "FileScan" in x and "l_shipdate" in x)
    assert "l_shipdate" in scan.split("PushedFilters")[1] and "ubquery" not in text and re.search(r"l_shipdate#\d+ >= 1998-\d\d", text) and re.search(r"l_shipdate#\d+ < 199\d-\d\d", text)
    monthly = plan(common.sold(tables, "store_sales", "d_moy = 11"))
    assert "l_shipdate >=" not in monthly and "ubquery" not in monthly
    other = plan(common.sold(tables, "store_sales", "d_month_seq between 1180 and 1191"))
    assert "ubquery" in other
