"""Shared pieces: dates, channel views and star joins."""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.sources.derive import JULIAN
from tidemark.sources.star import STORED_DAYS

Tables = Mapping[str, DataFrame]

DAY_NAMES = ("Sunday", "Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday")

# Per channel: sales table, prefix, buyer and address columns, order number.
SALES = {
    "store": ("store_sales", "ss", "ss_customer_sk", "ss_addr_sk", "ss_ticket_number"),
    "catalog": ("catalog_sales", "cs", "cs_bill_customer_sk", "cs_bill_addr_sk", "cs_order_number"),
    "web": ("web_sales", "ws", "ws_bill_customer_sk", "ws_bill_addr_sk", "ws_order_number"),
}
SOLD = {table: f"{p}_sold_date_sk" for table, p, *_ in SALES.values()}
# Per channel: returns table, prefix, order number, amount.
RETURNS = {
    "store": ("store_returns", "sr", "sr_ticket_number", "sr_return_amt"),
    "catalog": ("catalog_returns", "cr", "cr_order_number", "cr_return_amount"),
    "web": ("web_returns", "wr", "wr_order_number", "wr_return_amt"),
}


def join(left: DataFrame, right: DataFrame, on: str, how: str = "inner") -> DataFrame:
    days = getattr(right, "chosen_days", None)
    key = on.removesuffix(" = d_date_sk")
    if days is not None and how == "inner" and key != on and key in STORED_DAYS:
        left = _pruned(left, days, getattr(right, "chosen_span", None), *STORED_DAYS[key])
    return left.join(right, F.expr(on), how)


#: Calendar columns that tell days of different years apart.
DATED = re.compile(r"\bd_(date|date_sk|year|month_seq|week_seq|quarter_seq|quarter_name|date_id)\b")
_NUMBER = r"\(?\s*(\d+)\b\s*\)?"


def _numbers(where: str, column: str) -> tuple[int, int] | None:
    """Least and greatest value that a condition, one of several that all hold, leaves a
    column that has whole numbers."""
    for pattern in (rf"\b{column} = {_NUMBER}(?!\s*[-+*/])", rf"\b{column} between {_NUMBER} and {_NUMBER}(?!\s*[-+*/])"):
        found = re.search(pattern, where)
        if found:
            return int(found.group(1)), int(found.group(found.lastindex))
    found = re.search(rf"\b{column} in \(([\d, ]+)\)", where)
    return (min(v := [int(x) for x in found.group(1).split(",")]), max(v)) if found else None


def span_of(where: str) -> tuple[dt.date, dt.date] | None:
    """First and last day that a condition on the calendar can choose, where its own text says
    so: by date, or by year and month. None where it does not, or has alternatives."""
    if re.search(r"\b(or|not|case)\b", where, re.I):
        return None
    found = re.search(r"\bd_date between date '(\d{4}-\d\d-\d\d)' and (?:date '(\d{4}-\d\d-\d\d)'|date_add\(date '(\d{4}-\d\d-\d\d)', (\d+)\))", where)
    if found:
        first = dt.date.fromisoformat(found.group(1))
        return first, dt.date.fromisoformat(found.group(2)) if found.group(2) else dt.date.fromisoformat(found.group(3)) + dt.timedelta(days=int(found.group(4)))
    years = _numbers(where, "d_year")
    if years is None:
        return None
    quarters = _numbers(where, "d_qoy")
    months = _numbers(where, "d_moy") or ((quarters[0] * 3 - 2, quarters[1] * 3) if quarters else (1, 12))
    after = dt.date(years[1] + months[1] // 12, months[1] % 12 + 1, 1)
    return dt.date(years[0], months[0], 1), after - dt.timedelta(days=1)


def _pruned(fact: DataFrame, days: DataFrame, span: tuple[dt.date, dt.date] | None, stored: str, least: int, most: int) -> DataFrame:
    """A fact cut to the stored days that its date key can come from: a range on a stored
    column. Its ends follow from the condition's text, or are found in the calendar before
    the scan starts. Files and row groups outside are skipped."""
    if stored not in fact.columns:
        return fact
    if span:
        first, last = span[0] - dt.timedelta(days=most), span[1] - dt.timedelta(days=least - 1)
        return fact.filter((F.col(stored) >= F.lit(str(first)).cast("timestamp_ntz")) & (F.col(stored) < F.lit(str(last)).cast("timestamp_ntz")))
    end = lambda f, later: days.agg(F.date_from_unix_date((f("d_date_sk") - JULIAN - later).cast("int")).cast("timestamp_ntz")).scalar()
    return fact.filter((F.col(stored) >= end(F.min, most)) & (F.col(stored) < end(F.max, least - 1)))


def dates(t: Tables, where: str | Column = "true", *columns: str) -> DataFrame:
    """Days that satisfy a condition. The calendar has a fixed number of rows at
    every scale (about 73,000 in the benchmark), so it is always broadcast."""
    days = t["date_dim"].filter(where)
    out = F.broadcast(days.select("d_date_sk", *columns))
    # A condition that holds in every year, a month's or a weekday's, prunes nothing.
    if not isinstance(where, str) or DATED.search(where):
        out.chosen_days = days  # by which `join` prunes the fact
        out.chosen_span = span_of(where) if isinstance(where, str) else None
    return out


def days_from(start: str, days: int) -> str:
    return f"d_date between date '{start}' and date_add(date '{start}', {days})"


def sold(t: Tables, table: str, when: str | Column, *columns: str, key: str | None = None) -> DataFrame:
    """A fact joined to the days of its date key."""
    key = key or SOLD[table]
    return join(t[table], dates(t, when, *columns), f"{key} = d_date_sk")


def channel(t: Tables, name: str, *measures: str) -> DataFrame:
    """One channel's sales under names common to all channels."""
    table, p, customer, address, order = SALES[name]
    return t[table].select(
        F.lit(name).alias("channel"), *[F.col(c).alias("stored_day") for c in (f"{p}_stored_day",) if c in t[table].columns],
        F.col(f"{p}_sold_date_sk").alias("date_sk"), F.col(f"{p}_item_sk").alias("item_sk"),
        F.col(customer).alias("customer_sk"), F.col(address).alias("addr_sk"), F.col(order).alias("order_no"),
        *[F.col(f"{p}_{m}").alias(m) for m in measures],
    )


def channel_returns(t: Tables, name: str, *measures: str) -> DataFrame:
    table, p, order, amount = RETURNS[name]
    return t[table].select(
        F.lit(name).alias("channel"), F.col(f"{p}_returned_date_sk").alias("back_date_sk"),
        F.col(f"{p}_item_sk").alias("back_item_sk"), F.col(order).alias("back_order_no"), F.col(amount).alias("back_amount"),
        *[F.col(f"{p}_{m}").alias(f"back_{m}") for m in measures],
    )


def channels(t: Tables, *measures: str, names: tuple[str, ...] = ("store", "catalog", "web")) -> DataFrame:
    out = channel(t, names[0], *measures)
    for n in names[1:]:
        out = out.unionByName(channel(t, n, *measures))
    return out


def same_order(how: str = "left"):
    """Join of a channel view with its returns on item and order number."""
    def attach(sales: DataFrame, back: DataFrame) -> DataFrame:
        return join(sales, back.drop("channel"), "item_sk = back_item_sk and order_no = back_order_no", how)
    return attach


def by_day(value: str, agg=None) -> list[Column]:
    """One conditional sum per weekday."""
    return [F.sum(F.when(F.col("d_day_name") == d, F.col(value))).alias(f"{d[:3].lower()}_sales") for d in DAY_NAMES]


def any_of(conditions: list[str]) -> Column:
    return F.expr(" or ".join(f"({c})" for c in conditions))


def latency(ship: str, start: str) -> list[Column]:
    """Counts of rows by days between two date keys: to 30, 60, 90, 120, beyond."""
    gap = F.col(ship) - F.col(start)
    edges = [(None, 30, "days_30"), (30, 60, "days_31_60"), (60, 90, "days_61_90"), (90, 120, "days_91_120"), (120, None, "days_over_120")]
    out = []
    for low, high, name in edges:
        cond = F.lit(True)
        if low is not None:
            cond = cond & (gap > low)
        if high is not None:
            cond = cond & (gap <= high)
        out.append(F.sum(F.when(cond, 1).otherwise(0)).alias(name))
    return out
