"""Sales against their returns, orders that were never returned, excess discounts."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions.columns import mean, ordered, ratio, total
from tidemark.operators.ranks import spread_rank
from tidemark.plans.tpcds.common import (
    SALES, Tables, any_of, channel, channel_returns, dates, days_from, join, latency, sold,
)
from tidemark.sources.shared import settle


def _above_usual(totals, by: str, factor: float = 1.2):
    """Rows whose total exceeds the average total of their group."""
    usual = totals.groupBy(F.col(by).alias("_k")).agg((F.lit(factor) * mean("ctr_total")).alias("_bound"))
    return join(totals, usual, f"{by} = _k and cast(ctr_total as double) > _bound").drop("_k", "_bound")


def q01(t: Tables, year: int = 1998, state: str = "TN", least: int = 60):
    back = sold(t, "store_returns", f"d_year = {year}", key="sr_returned_date_sk")
    totals = back.groupBy("sr_customer_sk", "sr_store_sk").agg(F.sum("sr_return_amt").alias("ctr_total")).filter(F.col("ctr_total") > least)
    stores = t["store"].filter(F.col("s_state") == state).select("s_store_sk")
    # The bound is per store: only the state's stores are needed on either side.
    local = join(totals, stores, "sr_store_sk = s_store_sk", "left_semi")
    out = join(_above_usual(local, "sr_store_sk"), t["customer"], "sr_customer_sk = c_customer_sk")
    return ordered(out.select("c_customer_id"), "c_customer_id", limit=100)


PERSON = ["c_customer_id", "c_salutation", "c_first_name", "c_last_name"]


def _state_returns(t: Tables, table: str, p: str, amount: str, year: int):
    back = sold(t, table, f"d_year = {year}", key=f"{p}_returned_date_sk")
    placed = join(back, t["customer_address"].select("ca_address_sk", F.col("ca_state").alias("ctr_state")), f"{p}_returning_addr_sk = ca_address_sk")
    totals = placed.groupBy(F.col(f"{p}_returning_customer_sk").alias("ctr_customer_sk"), "ctr_state").agg(F.sum(amount).alias("ctr_total"))
    return _above_usual(totals, "ctr_state").withColumn("ctr_total_return", F.col("ctr_total").cast("double"))


def _local_people(t: Tables, state: str):
    return join(t["customer"], t["customer_address"].filter(F.col("ca_state") == state), "c_current_addr_sk = ca_address_sk")


def q30(t: Tables, year: int = 1998, state: str = "GA"):
    cols = [*PERSON, "c_preferred_cust_flag", "c_birth_day", "c_birth_month", "c_birth_year", "c_birth_country", "c_login",
            "c_email_address", "c_last_review_date", "ctr_total_return"]
    out = join(_state_returns(t, "web_returns", "wr", "wr_return_amt", year), _local_people(t, state), "ctr_customer_sk = c_customer_sk")
    return ordered(out.select(*cols), *cols, limit=100)


def q81(t: Tables, year: int = 1998, state: str = "GA"):
    cols = [*PERSON, *[f"ca_{c}" for c in ("street_number", "street_name", "street_type", "suite_number", "city", "county", "state", "zip",
                                          "country", "gmt_offset", "location_type")], "ctr_total_return"]
    out = join(_state_returns(t, "catalog_returns", "cr", "cr_return_amount_inc_tax", year), _local_people(t, state), "ctr_customer_sk = c_customer_sk")
    return ordered(out.select(*cols), *cols, limit=100)


def _split_orders(facts, p: str):
    """Order numbers shipped from several warehouses: the least and greatest
    warehouse of an order differ, which needs no self-join."""
    per = facts.filter(f"{p}_warehouse_sk is not null").groupBy(F.col(f"{p}_order_number").alias("split_no")).agg(
        F.min(f"{p}_warehouse_sk").alias("lo"), F.max(f"{p}_warehouse_sk").alias("hi"))
    return per.filter("lo <> hi").select("split_no")


def _order_totals(facts, p: str):
    return facts.agg(F.countDistinct(f"{p}_order_number").alias("order_count"),
                     total(f"{p}_ext_ship_cost").alias("total_shipping_cost"), total(f"{p}_net_profit").alias("total_net_profit"))


def _shipped(t: Tables, table: str, p: str, start: str, days: int, state: str):
    facts = join(t[table], dates(t, days_from(start, days)), f"{p}_ship_date_sk = d_date_sk")
    return join(facts, t["customer_address"].filter(F.col("ca_state") == state).select("ca_address_sk"), f"{p}_ship_addr_sk = ca_address_sk")


def q16(t: Tables, start: str = "1998-02-01", days: int = 60, state: str = "GA", county: str = "Williamson County"):
    centers = t["call_center"].filter(F.col("cc_county") == county).select("cc_call_center_sk")
    facts = join(_shipped(t, "catalog_sales", "cs", start, days, state), centers, "cs_call_center_sk = cc_call_center_sk")
    facts = join(facts.filter("cs_warehouse_sk is not null"), _split_orders(t["catalog_sales"], "cs"), "cs_order_number = split_no", "left_semi")
    return _order_totals(join(facts, t["catalog_returns"].select("cr_order_number"), "cs_order_number = cr_order_number", "left_anti"), "cs")


def q94(t: Tables, start: str = "1999-02-01", days: int = 60, state: str = "TX", company: str = "pri"):
    sites = t["web_site"].filter(F.col("web_company_name") == company).select("web_site_sk")
    facts = join(_shipped(t, "web_sales", "ws", start, days, state), sites, "ws_web_site_sk = web_site_sk")
    facts = join(facts.filter("ws_warehouse_sk is not null"), _split_orders(t["web_sales"], "ws"), "ws_order_number = split_no", "left_semi")
    return _order_totals(join(facts, t["web_returns"].select("wr_order_number"), "ws_order_number = wr_order_number", "left_anti"), "ws")


def q95(t: Tables, start: str = "1999-02-01", days: int = 60, state: str = "TX", company: str = "pri", quantities=(1, 50)):
    """Orders split over warehouses (counting lines of some quantities) and returned."""
    sites = t["web_site"].filter(F.col("web_company_name") == company).select("web_site_sk")
    facts = join(_shipped(t, "web_sales", "ws", start, days, state), sites, "ws_web_site_sk = web_site_sk")
    split = _split_orders(t["web_sales"].filter(F.col("ws_quantity").between(*quantities)), "ws")
    facts = join(facts, split, "ws_order_number = split_no", "left_semi")
    return _order_totals(join(facts, t["web_returns"].select("wr_order_number"), "ws_order_number = wr_order_number", "left_semi"), "ws")


def _excess(t: Tables, table: str, p: str, manufact: int, start: str, factor: float):
    items = t["item"].filter(f"i_manufact_id = {manufact}").select("i_item_sk")
    facts = join(sold(t, table, days_from(start, 90)), items, f"{p}_item_sk = i_item_sk", "left_semi")
    usual = facts.groupBy(F.col(f"{p}_item_sk").alias("k")).agg((F.lit(factor) * mean(f"{p}_ext_discount_amt")).alias("bound"))
    over = join(facts, usual, f"{p}_item_sk = k and cast({p}_ext_discount_amt as double) > bound")
    return over.agg(total(f"{p}_ext_discount_amt").alias("excess_discount_amount"))


def q32(t: Tables, manufact: int = 7, start: str = "1998-01-27"):
    return _excess(t, "catalog_sales", "cs", manufact, start, 1.3)


def q92(t: Tables, manufact: int = 7, start: str = "1998-01-27"):
    return _excess(t, "web_sales", "ws", manufact, start, 1.3)


def _rebuys(t: Tables, sale: str, back: str, again: str):
    """Store sale, its return, and the same customer's later catalog purchase."""
    returned = sold(t, "store_returns", back, key="sr_returned_date_sk").drop("d_date_sk")
    first = sold(t, "store_sales", sale).drop("d_date_sk")
    both = join(first, returned, "ss_customer_sk = sr_customer_sk and ss_item_sk = sr_item_sk and ss_ticket_number = sr_ticket_number")
    bought = sold(t, "catalog_sales", again).drop("d_date_sk")
    rows = join(both, bought, "sr_customer_sk = cs_bill_customer_sk and sr_item_sk = cs_item_sk")
    return join(join(rows, t["store"], "ss_store_sk = s_store_sk"), t["item"], "ss_item_sk = i_item_sk")


def q17(t: Tables, year: int = 1998):
    quarters = f"d_quarter_name in ('{year}Q1', '{year}Q2', '{year}Q3')"
    keys = ["i_item_id", "i_item_desc", "s_state"]
    aggs = []
    for name, c in (("store_sales", "ss_quantity"), ("store_returns", "sr_return_quantity"), ("catalog_sales", "cs_quantity")):
        # Rounded, as the last digits of a deviation depend on the order of rows.
        dev = F.stddev_samp(c)
        aggs += [F.count(c).alias(f"{name}_count"), mean(c).alias(f"{name}_ave"), F.round(dev, 6).alias(f"{name}_stdev"),
                 F.round(dev / mean(c), 6).alias(f"{name}_cov")]
    out = _rebuys(t, f"d_quarter_name = '{year}Q1'", quarters, quarters).groupBy(*keys).agg(*aggs)
    return ordered(out, *keys, limit=100)


KEYS_25 = ["i_item_id", "i_item_desc", "s_store_id", "s_store_name"]


def q25(t: Tables, year: int = 1998, month: int = 4):
    later = f"d_moy between {month} and {month + 6} and d_year = {year}"
    out = _rebuys(t, f"d_moy = {month} and d_year = {year}", later, later).groupBy(*KEYS_25).agg(
        total("ss_net_profit").alias("store_sales_profit"), total("sr_net_loss").alias("store_returns_loss"), total("cs_net_profit").alias("catalog_sales_profit"))
    return ordered(out, *KEYS_25, limit=100)


def q29(t: Tables, year: int = 1998, month: int = 4):
    out = _rebuys(t, f"d_moy = {month} and d_year = {year}", f"d_moy between {month} and {month + 3} and d_year = {year}",
                  f"d_year between {year} and {year + 2}").groupBy(*KEYS_25).agg(
        F.sum("ss_quantity").alias("store_sales_quantity"), F.sum("sr_return_quantity").alias("store_returns_quantity"), F.sum("cs_quantity").alias("catalog_sales_quantity"))
    return ordered(out, *KEYS_25, limit=100)


def q24(t: Tables, market: int = 3, color: str = "sienna", share: float = 0.05):
    """Net paid for returned lines by customers of a birth country, per colour.

    Addresses match on country and the store's zip only, so each sale repeats
    once per address: they are counted per zip and state, and weigh the sum.
    """
    back = t["store_returns"].groupBy("sr_ticket_number", "sr_item_sk").agg(F.count("*").alias("returns"))
    rows = join(t["store_sales"], back, "ss_ticket_number = sr_ticket_number and ss_item_sk = sr_item_sk")
    rows = join(rows, t["store"].filter(f"s_market_id = {market}"), "ss_store_sk = s_store_sk")
    rows = join(join(rows, t["customer"], "ss_customer_sk = c_customer_sk"), t["item"], "ss_item_sk = i_item_sk")
    places = t["customer_address"].groupBy(F.upper("ca_country").alias("land"), "ca_zip", "ca_state").agg(F.count("*").alias("homes"))
    rows = join(rows, places, "c_birth_country = land and s_zip = ca_zip")
    keys = ["c_last_name", "c_first_name", "s_store_name", "ca_state", "s_state", "i_color", "i_current_price", "i_manager_id", "i_units", "i_size"]
    sales = rows.groupBy(*keys).agg(F.sum(F.expr("ss_net_paid * returns * homes")).alias("netpaid"))
    bound = sales.agg(F.lit(share) * mean("netpaid")).scalar()
    out = sales.filter(F.col("i_color") == color).groupBy("c_last_name", "c_first_name", "s_store_name").agg(total("netpaid").alias("paid"))
    return ordered(out.filter(F.col("paid") > bound), "c_last_name", "c_first_name", "s_store_name", "paid")


def q40(t: Tables, day: str = "1999-03-11", low: float = 20.0, high: float = 40.0):
    facts = sold(t, "catalog_sales", f"d_date between date_sub(date '{day}', 30) and date_add(date '{day}', 30)", "d_date")
    facts = join(facts, t["item"].filter(F.col("i_current_price").between(low, high)), "cs_item_sk = i_item_sk")
    facts = join(facts, t["catalog_returns"].select("cr_order_number", "cr_item_sk", "cr_refunded_cash"),
                 "cs_order_number = cr_order_number and cs_item_sk = cr_item_sk", "left")
    facts = join(facts, t["warehouse"], "cs_warehouse_sk = w_warehouse_sk")
    net = "cs_sales_price - coalesce(cr_refunded_cash, 0)"
    out = facts.groupBy("w_state", "i_item_id").agg(
        total(f"case when d_date < date '{day}' then {net} else 0 end").alias("sales_before"),
        total(f"case when d_date >= date '{day}' then {net} else 0 end").alias("sales_after"))
    return ordered(out, "w_state", "i_item_id", limit=100)


def q49(t: Tables, days: str = "d_year = 1998 and d_moy = 12", least: int = 500, n: int = 10):
    """Items with the lowest return ratios per channel, by quantity or by money.

    A return above `least` is required, so the left join keeps matched rows only.
    """
    parts = []
    for name in ("web", "catalog", "store"):
        sales = channel(t, name, "quantity", "net_paid", "net_profit").filter("net_profit > 1 and net_paid > 0 and quantity > 0")
        back = channel_returns(t, name, "return_quantity").filter(F.col("back_amount") > least).drop("channel", "back_date_sk")
        rows = join(sales, dates(t, days), "date_sk = d_date_sk")
        parts.append(join(rows, back, "item_sk = back_item_sk and order_no = back_order_no"))
    per = parts[0].unionByName(parts[1]).unionByName(parts[2]).groupBy("channel", F.col("item_sk").alias("item")).agg(
        ratio(F.sum("back_return_quantity"), F.sum("quantity")).alias("return_ratio"),
        ratio(F.sum("back_amount"), F.sum("net_paid")).alias("currency_ratio"))
    # Both ratios in one column are ranked in one pass; it reads them several times, so they are kept.
    both = F.array(*[F.struct(F.lit(k).alias("kind"), F.col(f"{k}_ratio").alias("v")) for k in ("return", "currency")])
    long = settle(per.select("channel", "item", F.explode(both).alias("r")).select("channel", "item", "r.kind", "r.v"))
    ranked = spread_rank(long, "v", "rank", ["channel", "kind"])
    side = {k: F.col("kind") == k for k in ("return", "currency")}
    out = ranked.groupBy("channel", "item").agg(
        F.max(F.when(side["return"], F.col("v"))).alias("return_ratio"), F.max(F.when(side["return"], F.col("rank"))).alias("return_rank"),
        F.max(F.when(side["currency"], F.col("rank"))).alias("currency_rank")).filter(F.least("return_rank", "currency_rank") <= n)
    return ordered(out, "channel", "return_rank", "currency_rank", "item", "return_ratio", limit=100)


def q50(t: Tables, year: int = 1998, month: int = 8):
    back = sold(t, "store_returns", f"d_year = {year} and d_moy = {month}", key="sr_returned_date_sk").drop("d_date_sk")
    rows = join(t["store_sales"], back, "ss_ticket_number = sr_ticket_number and ss_item_sk = sr_item_sk and ss_customer_sk = sr_customer_sk")
    rows = join(join(rows, dates(t), "ss_sold_date_sk = d_date_sk"), t["store"], "ss_store_sk = s_store_sk")
    keys = ["s_store_name", "s_company_id", *[f"s_{c}" for c in ("street_number", "street_name", "street_type", "suite_number", "city", "county", "state", "zip")]]
    return ordered(rows.groupBy(*keys).agg(*latency("sr_returned_date_sk", "ss_sold_date_sk")), *keys, limit=100)


def q93(t: Tables, reason: str = "reason 28"):
    # The reason is tested on the returned side, so unmatched sales drop out.
    back = join(t["store_returns"], F.broadcast(t["reason"].filter(F.col("r_reason_desc") == reason)), "sr_reason_sk = r_reason_sk")
    rows = join(t["store_sales"], back, "ss_item_sk = sr_item_sk and ss_ticket_number = sr_ticket_number")
    kept = "case when sr_return_quantity is not null then (ss_quantity - sr_return_quantity) * ss_sales_price else ss_quantity * ss_sales_price end"
    return ordered(rows.groupBy("ss_customer_sk").agg(total(kept).alias("sumsales")), "sumsales", "ss_customer_sk", limit=100)


def q75(t: Tables, category: str = "Books", year: int = 1999, share: float = 0.9):
    """Net sales per item class that fell against the year before.

    UNION keeps one of equal detail rows, so the details are made distinct.
    """
    items = t["item"].filter(F.col("i_category") == category)
    keys = ["d_year", "i_brand_id", "i_class_id", "i_category_id", "i_manufact_id"]
    detail = None
    for name in SALES:
        rows = join(channel(t, name, "quantity", "ext_sales_price"), dates(t, f"d_year in ({year - 1}, {year})", "d_year"), "date_sk = d_date_sk")
        back = channel_returns(t, name, "return_quantity").drop("channel", "back_date_sk")
        rows = join(join(rows, items, "item_sk = i_item_sk"), back, "item_sk = back_item_sk and order_no = back_order_no", "left")
        part = rows.select(*keys, F.expr("quantity - coalesce(back_return_quantity, 0)").alias("cnt"),
                           F.expr("ext_sales_price - coalesce(back_amount, 0)").alias("amt"))
        detail = part if detail is None else detail.unionByName(part)
    # Both years side by side instead of a self-join of the yearly totals.
    now, ago = F.col("d_year") == year, F.col("d_year") == year - 1
    out = detail.distinct().groupBy(*keys[1:]).agg(
        F.sum(F.when(ago, F.col("cnt"))).alias("prev_yr_cnt"), F.sum(F.when(now, F.col("cnt"))).alias("curr_yr_cnt"),
        F.sum(F.when(ago, F.col("amt"))).alias("a"), F.sum(F.when(now, F.col("amt"))).alias("b"))
    out = out.filter(ratio("curr_yr_cnt", "prev_yr_cnt") < share).select(
        F.lit(year - 1).alias("prev_year"), F.lit(year).alias("year"), *keys[1:], "prev_yr_cnt", "curr_yr_cnt",
        F.expr("curr_yr_cnt - prev_yr_cnt").alias("sales_cnt_diff"), F.expr("b - a").cast("double").alias("sales_amt_diff"))
    return ordered(out, "sales_cnt_diff", "sales_amt_diff", *keys[1:], limit=100)


def q78(t: Tables, year: int = 1998, quantities=(1, 50)):
    """Unreturned store sales against the other channels' per customer and item.

    LEFT JOIN ... IS NULL is an anti join; one grouping carries all channels.
    """
    rows = None
    for name in SALES:
        sales = channel(t, name, "quantity", "wholesale_cost", "sales_price").filter(F.col("quantity").between(*quantities))
        back = channel_returns(t, name).select("back_item_sk", "back_order_no")
        part = join(join(sales, dates(t, f"d_year = {year}"), "date_sk = d_date_sk"), back, "item_sk = back_item_sk and order_no = back_order_no", "left_anti")
        rows = part if rows is None else rows.unionByName(part)
    per = rows.groupBy("item_sk", "customer_sk").agg(*[
        F.sum(F.when(F.col("channel") == n, F.col(c))).alias(f"{n}_{c}") for n in SALES for c in ("quantity", "wholesale_cost", "sales_price")])
    zero = F.lit(0)
    out = per.filter("store_quantity is not null").select(
        F.lit(year).alias("ss_sold_year"), F.col("item_sk").alias("ss_item_sk"), F.col("customer_sk").alias("ss_customer_sk"),
        # Whole numbers divide to a whole number.
        F.expr("store_quantity div coalesce(web_quantity + catalog_quantity, 1)").alias("ratio"),
        F.col("store_quantity").alias("store_qty"), F.col("store_wholesale_cost").cast("double").alias("store_wholesale_cost"),
        F.col("store_sales_price").cast("double").alias("store_sales_price"),
        (F.coalesce("web_quantity", zero) + F.coalesce("catalog_quantity", zero)).alias("other_chan_qty"),
        (F.coalesce("web_wholesale_cost", zero) + F.coalesce("catalog_wholesale_cost", zero)).cast("double").alias("other_chan_wholesale_cost"),
        (F.coalesce("web_sales_price", zero) + F.coalesce("catalog_sales_price", zero)).cast("double").alias("other_chan_sales_price"))
    return ordered(out, "ss_sold_year", "ss_item_sk", "ss_customer_sk", "-store_qty", limit=100)


def q83(t: Tables, days=tuple(f"1998-{m:02d}-15" for m in range(1, 13))):
    """Items returned in all three channels in some weeks."""
    weeks = t["date_dim"].filter(F.col("d_date").isin([F.lit(d).cast("date") for d in days])).select(F.col("d_week_seq").alias("w"))
    in_weeks = join(t["date_dim"], weeks, "d_week_seq = w", "left_semi").select("d_date_sk")
    rows = None
    for name in SALES:
        part = join(channel_returns(t, name, "return_quantity"), F.broadcast(in_weeks), "back_date_sk = d_date_sk")
        rows = part if rows is None else rows.unionByName(part)
    per = join(rows, t["item"], "back_item_sk = i_item_sk").groupBy(F.col("i_item_id").alias("item_id")).agg(*[
        F.sum(F.when(F.col("channel") == n, F.col("back_return_quantity"))).alias(f"{p}_item_qty") for n, p in (("store", "sr"), ("catalog", "cr"), ("web", "wr"))])
    whole = "(sr_item_qty + cr_item_qty + wr_item_qty)"
    out = per.filter(f"{whole} is not null").select("item_id", *[c for p in ("sr", "cr", "wr") for c in (
        F.col(f"{p}_item_qty"), (ratio(f"{p}_item_qty", whole) / 3.0 * 100).alias(f"{p}_dev"))], (F.expr(whole) / F.lit(3.0)).alias("average"))
    return ordered(out, "item_id", "sr_item_qty", limit=100)


def q85(t: Tables, year: int = 1998):
    """Return reasons under three demographic bands and three regional ones."""
    back = t["web_returns"].select("wr_item_sk", "wr_order_number", "wr_refunded_cdemo_sk", "wr_returning_cdemo_sk", "wr_refunded_addr_sk",
                                   "wr_reason_sk", "wr_refunded_cash", "wr_fee")
    rows = join(sold(t, "web_sales", f"d_year = {year}"), back, "ws_item_sk = wr_item_sk and ws_order_number = wr_order_number")
    rows = join(rows, t["web_page"].select("wp_web_page_sk"), "ws_web_page_sk = wp_web_page_sk")
    demo = t["customer_demographics"]
    one = demo.select(F.col("cd_demo_sk").alias("k1"), F.col("cd_marital_status").alias("m1"), F.col("cd_education_status").alias("e1"))
    two = demo.select(F.col("cd_demo_sk").alias("k2"), F.col("cd_marital_status").alias("m2"), F.col("cd_education_status").alias("e2"))
    # Equal status on both sides is common to all arms, so it is a join key.
    rows = join(join(rows, one, "wr_refunded_cdemo_sk = k1"), two, "wr_returning_cdemo_sk = k2 and m1 = m2 and e1 = e2")
    rows = rows.filter(any_of([
        "m1 = 'M' and ws_sales_price between 100 and 150",
        "m1 = 'S' and ws_sales_price between 50 and 100",
        "m1 = 'W' and ws_sales_price between 20 and 200",
    ]))
    rows = join(rows, t["customer_address"].filter("ca_country = 'United States'"), "wr_refunded_addr_sk = ca_address_sk").filter(any_of([
        "ca_state in ('TX', 'OH') and ws_net_profit between 0 and 2000",
        "ca_state in ('GA', 'NM', 'KY') and ws_net_profit between 150 and 3000",
        "ca_state in ('VA', 'CA') and ws_net_profit between 50 and 2500",
    ]))
    rows = join(rows, F.broadcast(t["reason"]), "wr_reason_sk = r_reason_sk")
    out = rows.groupBy("r_reason_desc").agg(mean("ws_quantity").alias("avg_quantity"), mean("wr_refunded_cash").alias("avg_cash"), mean("wr_fee").alias("avg_fee"))
    out = out.select(F.substring("r_reason_desc", 1, 20).alias("reason"), "avg_quantity", "avg_cash", "avg_fee")
    return ordered(out, "reason", "avg_quantity", "avg_cash", "avg_fee", limit=100)


def q64(t: Tables, year: int = 1999, colors=("purple", "slate", "medium", "powder", "brown", "orange"), price=(1, 90)):
    """Returned store items resold in the next year by the same store."""
    listed = join(t["catalog_sales"], t["catalog_returns"], "cs_item_sk = cr_item_sk and cs_order_number = cr_order_number").groupBy("cs_item_sk").agg(
        F.sum("cs_ext_list_price").alias("sale"), F.sum(F.expr("cr_refunded_cash + cr_reversed_charge + cr_store_credit")).alias("refund"))
    resold = listed.filter("sale > 2 * refund").select("cs_item_sk")
    items = t["item"].filter(F.col("i_color").isin(*colors) & F.col("i_current_price").between(*price)).select("i_item_sk", "i_product_name")
    items = join(items, resold, "i_item_sk = cs_item_sk", "left_semi")
    rows = join(sold(t, "store_sales", f"d_year in ({year}, {year + 1})", F.col("d_year").alias("syear")), items, "ss_item_sk = i_item_sk")
    rows = join(rows, t["store_returns"].select("sr_item_sk", "sr_ticket_number"), "ss_item_sk = sr_item_sk and ss_ticket_number = sr_ticket_number")
    rows = join(rows, t["store"].select("s_store_sk", "s_store_name", "s_zip"), "ss_store_sk = s_store_sk")
    rows = join(rows, t["promotion"].select("p_promo_sk"), "ss_promo_sk = p_promo_sk")
    demo = t["customer_demographics"]
    rows = join(rows, demo.select(F.col("cd_demo_sk").alias("k1"), F.col("cd_marital_status").alias("m1")), "ss_cdemo_sk = k1")
    homes = join(t["household_demographics"], t["income_band"], "hd_income_band_sk = ib_income_band_sk").select("hd_demo_sk")
    rows = join(rows, homes.withColumnRenamed("hd_demo_sk", "h1"), "ss_hdemo_sk = h1")

    def place(p: str):
        return t["customer_address"].select(F.col("ca_address_sk").alias(f"{p}_sk"), *[
            F.col(f"ca_{c}").alias(f"{p}_{c}") for c in ("street_number", "street_name", "city", "zip")])

    people = join(t["customer"], demo.select(F.col("cd_demo_sk").alias("k2"), F.col("cd_marital_status").alias("m2")), "c_current_cdemo_sk = k2")
    people = join(join(people, homes, "c_current_hdemo_sk = hd_demo_sk"), place("c"), "c_current_addr_sk = c_sk")
    for key, name in (("c_first_sales_date_sk", "fsyear"), ("c_first_shipto_date_sk", "s2year")):
        day = F.broadcast(t["date_dim"].select(F.col("d_date_sk").alias(f"{name}_sk"), F.col("d_year").alias(name)))
        people = join(people, day, f"{key} = {name}_sk")
    rows = join(join(rows, people, "ss_customer_sk = c_customer_sk and m1 <> m2"), place("b"), "ss_addr_sk = b_sk")
    keys = ["i_product_name", "i_item_sk", "s_store_name", "s_zip", *[f"{p}_{c}" for p in "bc" for c in ("street_number", "street_name", "city", "zip")],
            "syear", "fsyear", "s2year"]
    cross = rows.groupBy(*keys).agg(F.count("*").alias("cnt"), total("ss_wholesale_cost").alias("s1"), total("ss_list_price").alias("s2"), total("ss_coupon_amt").alias("s3"))
    first = cross.filter(F.col("syear") == year)
    second = cross.filter(F.col("syear") == year + 1).select(
        F.col("i_item_sk").alias("i2"), F.col("s_store_name").alias("n2"), F.col("s_zip").alias("z2"), F.col("syear").alias("syear_2"),
        F.col("cnt").alias("cnt_2"), *[F.col(s).alias(f"{s}_2") for s in ("s1", "s2", "s3")])
    out = join(first, second, "i_item_sk = i2 and s_store_name = n2 and s_zip = z2 and cnt_2 <= cnt")
    cols = [*[k for k in keys if k not in ("i_item_sk", "fsyear", "s2year")], "cnt", "s1", "s2", "s3", "s1_2", "s2_2", "s3_2", "syear_2", "cnt_2"]
    return ordered(out.select(*cols), "i_product_name", "s_store_name", "cnt_2")
