"""Shares, running totals, neighbours and ranks over aggregates."""

from __future__ import annotations

from pyspark.sql import Window as W, functions as F

from tidemark.functions.columns import mean, ordered, ratio
from tidemark.plans.tpcds.common import Tables, any_of, channel, dates, days_from, join, sold


def _class_share(t: Tables, table: str, p: str, start: str, categories, limit: int | None):
    """Item revenue and its share of the class's revenue."""
    items = t["item"].filter(F.col("i_category").isin(*categories))
    facts = join(sold(t, table, days_from(start, 30)), items, f"{p}_item_sk = i_item_sk")
    keys = ["i_item_id", "i_item_desc", "i_category", "i_class", "i_current_price"]
    per = facts.groupBy(*keys).agg(F.sum(f"{p}_ext_sales_price").alias("rev"))
    # The class total is its own aggregation: a window would gather a whole class in one task.
    whole = per.groupBy(F.col("i_class").alias("c")).agg(F.sum("rev").alias("all_rev"))
    out = join(per, whole, "i_class = c").select(
        "i_item_id", "i_item_desc", "i_category", "i_class", F.col("i_current_price").cast("double").alias("i_current_price"),
        F.col("rev").cast("double").alias("itemrevenue"), ratio(F.col("rev").cast("double") * 100, "all_rev").alias("revenueratio"))
    out = ordered(out, "i_category", "i_class", "i_item_id", "i_item_desc", "revenueratio", "i_current_price", limit=limit)
    return out.drop("i_item_id")


CATEGORIES = ("Sports", "Books", "Home")


def q12(t: Tables, start: str = "1999-02-22"):
    return _class_share(t, "web_sales", "ws", start, CATEGORIES, 100)


def q20(t: Tables, start: str = "1999-02-22"):
    return _class_share(t, "catalog_sales", "cs", start, CATEGORIES, 100)


def q98(t: Tables, start: str = "1999-02-22"):
    return _class_share(t, "store_sales", "ss", start, CATEGORIES, None)


def _off_average(per, keys: list[str], name: str, least: float = 0.1):
    """Rows whose sum is off the mean of its group by more than a tenth."""
    w = W.partitionBy(*keys)
    usual = F.try_divide(F.sum("x").over(w).cast("double"), F.count("x").over(w))
    rows = per.withColumn(name, usual).withColumn("sum_sales", F.col("x").cast("double")).drop("x")
    off = F.when(F.col(name) != 0, F.abs(F.col("sum_sales") - F.col(name)) / F.col(name))
    return rows.filter(off > least)


MIX = ("i_category in ('Books', 'Children', 'Electronics') and i_class in ('personal', 'portable', 'reference')",
       "i_category in ('Women', 'Music', 'Men') and i_class in ('accessories', 'classical', 'pants')")


def _by_period(t: Tables, key: str, period: str, year: int, mix, name: str):
    items = t["item"].filter(any_of(mix)).select("i_item_sk", key)
    facts = join(join(sold(t, "store_sales", f"d_year = {year}", period), items, "ss_item_sk = i_item_sk"), t["store"], "ss_store_sk = s_store_sk")
    per = facts.groupBy(key, period).agg(F.sum("ss_sales_price").alias("x"))
    return _off_average(per, [key], name).drop(period)


def q53(t: Tables, year: int = 1998, mix=MIX):
    out = _by_period(t, "i_manufact_id", "d_qoy", year, mix, "avg_quarterly_sales")
    return ordered(out, "avg_quarterly_sales", "sum_sales", "i_manufact_id", limit=100)


def q63(t: Tables, year: int = 1998, mix=MIX):
    out = _by_period(t, "i_manager_id", "d_moy", year, mix, "avg_monthly_sales")
    return ordered(out, "i_manager_id", "avg_monthly_sales", "sum_sales", limit=100)


def q89(t: Tables, year: int = 1998):
    items = t["item"].filter(any_of([
        "i_category in ('Books', 'Electronics', 'Sports') and i_class in ('personal', 'stereo', 'football')",
        "i_category in ('Men', 'Jewelry', 'Women') and i_class in ('shirts', 'pants', 'dresses')"]))
    facts = join(join(sold(t, "store_sales", f"d_year = {year}", "d_moy"), items, "ss_item_sk = i_item_sk"), t["store"], "ss_store_sk = s_store_sk")
    per = facts.groupBy("i_category", "i_class", "i_brand", "s_store_name", "s_company_name", "d_moy").agg(F.sum("ss_sales_price").alias("x"))
    out = _off_average(per, ["i_category", "i_brand", "s_store_name", "s_company_name"], "avg_monthly_sales").withColumn(
        "gap", F.col("sum_sales") - F.col("avg_monthly_sales"))
    cols = ["i_category", "i_class", "i_brand", "s_store_name", "s_company_name", "d_moy", "sum_sales", "avg_monthly_sales"]
    return ordered(out, "gap", "s_store_name", *cols[:3], "d_moy", limit=100).select(*cols)


def _neighbours(facts, keys: list[str], year: int, price: str, last: str):
    """Monthly sums against the month's neighbours and the yearly average.

    Rows rank by month without ties, so the rows one rank away are lag and lead.
    """
    per = facts.groupBy(*keys, "d_year", "d_moy").agg(F.sum(price).alias("x"))
    line = W.partitionBy(*keys).orderBy("d_year", "d_moy")
    yearly = W.partitionBy(*keys, "d_year")
    rows = per.select(
        *keys, "d_year", "d_moy", F.try_divide(F.sum("x").over(yearly).cast("double"), F.count("x").over(yearly)).alias("avg_monthly_sales"),
        F.col("x").cast("double").alias("sum_sales"), F.lag("x").over(line).cast("double").alias("psum"), F.lead("x").over(line).cast("double").alias("nsum"))
    off = F.abs(F.col("sum_sales") - F.col("avg_monthly_sales")) / F.col("avg_monthly_sales")
    out = rows.filter((F.col("d_year") == year) & (F.col("avg_monthly_sales") > 0) & F.expr("psum is not null and nsum is not null"))
    out = out.filter(off > 0.1).withColumn("gap", F.col("sum_sales") - F.col("avg_monthly_sales"))
    return ordered(out, "gap", last, *[k for k in keys if k != last], "d_moy", limit=100).drop("gap")


def q47(t: Tables, year: int = 1998, quantities=(1, 50), brands=(1001, 1010)):
    items = t["item"].filter(F.col("i_brand_id").between(*brands))
    facts = sold(t, "store_sales", f"d_year = {year}", "d_year", "d_moy").filter(F.col("ss_quantity").between(*quantities))
    facts = join(join(facts, items, "ss_item_sk = i_item_sk"), t["store"], "ss_store_sk = s_store_sk")
    return _neighbours(facts, ["i_category", "i_brand", "s_store_name", "s_company_name"], year, "ss_sales_price", "s_store_name")


def q57(t: Tables, year: int = 1998):
    days = f"d_year = {year} or (d_year = {year - 1} and d_moy = 12) or (d_year = {year + 1} and d_moy = 1)"
    facts = join(sold(t, "catalog_sales", days, "d_year", "d_moy"), t["item"], "cs_item_sk = i_item_sk")
    facts = join(facts, t["call_center"], "cs_call_center_sk = cc_call_center_sk")
    return _neighbours(facts, ["i_category", "i_brand", "cc_name"], year, "cs_sales_price", "cc_name")


def q44(t: Tables, store: int = 7, factor: float = 0.9, n: int = 10):
    """Best and worst items by average profit, side by side by rank. The rank
    filter lets every task keep its first rows only."""
    here = t["store_sales"].filter(F.col("ss_store_sk") == store)
    bound = here.filter("ss_addr_sk is null").agg(F.lit(factor) * mean("ss_net_profit")).scalar()
    per = here.groupBy("ss_item_sk").agg(mean("ss_net_profit").alias("profit")).filter(F.col("profit") > bound)
    items = t["item"].select("i_item_sk", "i_product_name")

    def ranked(order, name: str):
        top = per.withColumn("rnk", F.rank().over(W.orderBy(order))).filter(F.col("rnk") <= n)
        return join(items, top, "i_item_sk = ss_item_sk").select("rnk", F.col("i_product_name").alias(name))

    out = ranked(F.asc("profit"), "best_performing").join(ranked(F.desc("profit"), "worst_performing"), "rnk")
    return ordered(out, "rnk", "best_performing", "worst_performing", limit=100)


def _daily(t: Tables, name: str, year: int):
    rows = channel(t, name, "sales_price").filter("item_sk is not null")
    return join(rows, dates(t, f"d_year = {year}", "d_date"), "date_sk = d_date_sk")


def _running():
    return W.partitionBy("item_sk").orderBy("d_date").rowsBetween(W.unboundedPreceding, W.currentRow)


def _ahead(rows):
    """Days on which an item's cumulative web sales lead the store's."""
    out = rows.select(
        "item_sk", "d_date", F.col("web_sales").cast("double").alias("web_sales"), F.col("store_sales").cast("double").alias("store_sales"),
        F.max("web_sales").over(_running()).cast("double").alias("web_cumulative"), F.max("store_sales").over(_running()).cast("double").alias("store_cumulative"))
    return ordered(out.filter("web_cumulative > store_cumulative"), "item_sk", "d_date", limit=100)


def q51(t: Tables, year: int = 1998):
    """Running sums per channel, joined on both sides. An item has at most one
    row per day, which bounds every window."""
    def running(name: str):
        per = _daily(t, name, year).groupBy("item_sk", "d_date").agg(F.sum("sales_price").alias("s"))
        return per.select("item_sk", "d_date", F.sum("s").over(_running()).alias(f"{name}_sales"))

    return _ahead(running("web").join(running("store"), ["item_sk", "d_date"], "full"))


def q51a(t: Tables, year: int = 1998):
    """The same from one grouping: channels become columns, and a channel's
    running sum shows on the days it has sales."""
    rows = _daily(t, "web", year).unionByName(_daily(t, "store", year))
    per = rows.groupBy("item_sk", "d_date").agg(*[F.sum(F.when(F.col("channel") == n, F.col("sales_price"))).alias(n) for n in ("web", "store")])
    return _ahead(per.select("item_sk", "d_date", *[
        F.when(F.col(n).isNotNull(), F.sum(n).over(_running())).alias(f"{n}_sales") for n in ("web", "store")]))
