"""Stock levels: before and after a day, variation, shortage."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions.columns import mean, ordered
from tidemark.plans.tpcds.common import Tables, dates, days_from, join, sold


def _around(day: str) -> str:
    return f"d_date between date_sub(date '{day}', 30) and date_add(date '{day}', 30)"


def q21(t: Tables, day: str = "1999-03-11", low: float = 20.0, high: float = 40.0):
    items = t["item"].filter(F.col("i_current_price").between(low, high)).select("i_item_sk", "i_item_id")
    rows = join(join(t["inventory"], dates(t, _around(day), "d_date"), "inv_date_sk = d_date_sk"), items, "inv_item_sk = i_item_sk")
    rows = join(rows, t["warehouse"], "inv_warehouse_sk = w_warehouse_sk")
    out = rows.groupBy("w_warehouse_name", "i_item_id").agg(
        F.sum(F.expr(f"case when d_date < date '{day}' then inv_quantity_on_hand else 0 end")).alias("inv_before"),
        F.sum(F.expr(f"case when d_date >= date '{day}' then inv_quantity_on_hand else 0 end")).alias("inv_after"))
    # Sums of whole numbers divide to a whole number.
    kept = out.filter("case when inv_before > 0 then inv_after div inv_before end between 2.0 / 3.0 and 3.0 / 2.0")
    return ordered(kept, "w_warehouse_name", "i_item_id", limit=100)


def _stocked_and_sold(t: Tables, fact: str, key: str, price: float, start: str, makers):
    """Items of a price band in stock for two months which also sold."""
    items = t["item"].filter(F.col("i_current_price").between(price, price + 30) & F.col("i_manufact_id").isin(*makers))
    stock = join(t["inventory"].filter("inv_quantity_on_hand between 100 and 500"), dates(t, days_from(start, 60)), "inv_date_sk = d_date_sk")
    items = join(items, stock.select("inv_item_sk"), "i_item_sk = inv_item_sk", "left_semi")
    items = join(items, t[fact].select(key), f"i_item_sk = {key}", "left_semi")
    out = items.select("i_item_id", "i_item_desc", "i_current_price").distinct().withColumn("i_current_price", F.col("i_current_price").cast("double"))
    return ordered(out, "i_item_id", "i_item_desc", "i_current_price", limit=100)


def q37(t: Tables, price: float = 28.0, start: str = "1999-02-01", makers=(7, 14, 28, 42)):
    return _stocked_and_sold(t, "catalog_sales", "cs_item_sk", price, start, makers)


def q82(t: Tables, price: float = 62.0, start: str = "1999-05-25", makers=(9, 20, 21, 33)):
    return _stocked_and_sold(t, "store_sales", "ss_item_sk", price, start, makers)


def q39(t: Tables, year: int = 1999, month: int = 1, first: float = 1.5, second: float = 1.0):
    """Warehouse items whose stock varies much in two months running.

    Both months come from one aggregation; the month after is a lead, not a
    self-join. Deviations are rounded, as their last digits depend on row order.
    """
    rows = join(t["inventory"], dates(t, f"d_year = {year} and d_moy in ({month}, {month + 1})", "d_moy"), "inv_date_sk = d_date_sk")
    rows = join(join(rows, t["warehouse"], "inv_warehouse_sk = w_warehouse_sk"), t["item"].select("i_item_sk"), "inv_item_sk = i_item_sk")
    aggs = []
    for i, m in ((1, month), (2, month + 1)):
        q = F.when(F.col("d_moy") == m, F.col("inv_quantity_on_hand"))
        aggs += [mean(q).alias(f"mean{i}"), F.stddev_samp(q).alias(f"dev{i}")]
    per = rows.groupBy("w_warehouse_sk", "i_item_sk").agg(*aggs)
    cov = {i: F.when(F.col(f"mean{i}") != 0, F.col(f"dev{i}") / F.col(f"mean{i}")) for i in (1, 2)}
    out = per.filter((cov[1] > first) & (cov[2] > second)).select(
        "w_warehouse_sk", "i_item_sk", F.lit(month).alias("d_moy"), "mean1", F.round(cov[1], 6).alias("cov1"),
        F.lit(month + 1).alias("next_moy"), "mean2", F.round(cov[2], 6).alias("cov2"))
    return ordered(out, "w_warehouse_sk", "i_item_sk", "d_moy", "mean1", "cov1", "next_moy", "mean2", "cov2")


def q72(t: Tables, year: int = 1999, potential: str = ">10000", marital: str = "D"):
    """Catalog lines whose item was short in a warehouse in the week of sale.

    A line repeats for every return of it; returns are counted first. The promo
    counts count every row, as both branches of their CASE are non-null.
    """
    sales = sold(t, "catalog_sales", f"d_year = {year}", "d_week_seq").drop("d_date_sk").withColumnRenamed("d_week_seq", "week")
    homes = t["household_demographics"].filter(F.col("hd_buy_potential") == potential).select("hd_demo_sk")
    people = t["customer_demographics"].filter(F.col("cd_marital_status") == marital).select("cd_demo_sk")
    sales = join(join(sales, homes, "cs_bill_hdemo_sk = hd_demo_sk"), people, "cs_bill_cdemo_sk = cd_demo_sk").filter("cs_ship_date_sk > cs_sold_date_sk + 5")
    sales = join(sales, t["date_dim"].select(F.col("d_date_sk").alias("ship_day")), "cs_ship_date_sk = ship_day", "left_semi")
    back = t["catalog_returns"].groupBy("cr_item_sk", "cr_order_number").agg(F.count("*").alias("returns"))
    sales = join(sales, back, "cs_item_sk = cr_item_sk and cs_order_number = cr_order_number", "left")
    stock = join(t["inventory"], dates(t, f"d_year between {year - 1} and {year + 1}", "d_week_seq"), "inv_date_sk = d_date_sk")
    rows = join(stock, sales, "inv_item_sk = cs_item_sk and d_week_seq = week and inv_quantity_on_hand < cs_quantity")
    per = rows.groupBy("inv_item_sk", "inv_warehouse_sk", "week").agg(F.sum(F.expr("coalesce(returns, 1)")).alias("n"))
    named = join(join(per, t["item"].select("i_item_sk", "i_item_desc"), "inv_item_sk = i_item_sk"), t["warehouse"], "inv_warehouse_sk = w_warehouse_sk")
    out = named.groupBy("i_item_desc", "w_warehouse_name", F.col("week").alias("d_week_seq")).agg(F.sum("n").alias("total_cnt"))
    out = out.select("i_item_desc", "w_warehouse_name", "d_week_seq", F.col("total_cnt").alias("no_promo"), F.col("total_cnt").alias("promo"), "total_cnt")
    return ordered(out, "-total_cnt", "i_item_desc", "w_warehouse_name", "d_week_seq", limit=100)
