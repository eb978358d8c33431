"""Retail warehouse reports over order lines, orders and dimensions.

Each function is one report shape; the days, products and categories are
arguments. BETWEEN with a DATE upper bound takes in that day's midnight only,
as the reports have always done.
"""

from __future__ import annotations

from pyspark.sql import Window as W, functions as F

from tidemark.functions.columns import mean, ordered, total, when
from tidemark.plans.tpch import Tables, join


def between(start: str, end: str, column: str = "order_datetime") -> str:
    return f"{column} between timestamp_ntz '{start}' and timestamp_ntz '{end}'"


def during(lines, *span: str):
    """Rows whose order time lies in one of the spans (start, end, start, end, ...). A
    table that stores the time's day in order_day is first cut to the days from the first
    start to the last end: a plain range on a stored column, by which scans skip files
    and row groups."""
    spans = list(zip(span[::2], span[1::2]))
    if "order_day" in lines.columns:
        lines = lines.filter(between(min(a for a, _ in spans)[:10], max(b for _, b in spans), "order_day"))
    return lines.filter(" or ".join(f"({between(a, b)})" for a, b in spans))


def _volumes(lines):
    return lines.agg(
        F.countDistinct("order_id").alias("num_orders"),
        F.sum("item_quantity").alias("num_items"),
        F.countDistinct("customer_id").alias("num_customers"),
    )


def r001(t: Tables, day: str = "1998-01-05", next_day: str = "1998-01-06"):
    """Orders, items and customers of one day."""
    return _volumes(during(t["order_lineitems"], day, next_day))


def r565(t: Tables, start: str = "1998-10-01", end: str = "1998-12-31"):
    """The same for a month or a quarter."""
    return _volumes(during(t["order_lineitems"], start, end))


def r605(t: Tables, start: str = "2001-01-01", as_of: str = "2001-08-15"):
    """The same for the year to date."""
    return _volumes(during(t["order_lineitems"], start, as_of))


def r004(t: Tables, day: str = "1998-04-11", category: int = 10):
    """Shipping time and volumes of a category's day against the year before."""
    now = f"order_datetime between timestamp_ntz '{day}' and date_add(date '{day}', 1)"
    ago = f"order_datetime between date_sub(date '{day}', 366) and date_sub(date '{day}', 365)"
    products = t["products_dim"].filter(F.col("category_id") == category).select("product_id", "category_id")
    lines = (
        t["order_lineitems"].filter("ship_datetime is not null").filter(f"({now}) or ({ago})")
        .join(products, "product_id").join(t["categories_dim"], "category_id")
        .withColumn("wait", F.expr("cast(timestampdiff(second, order_datetime, ship_datetime) as bigint)"))
    )
    aggs = []
    for prefix, cond in (("", now), ("ya_", ago)):
        aggs += [
            mean(when(cond, "wait")).alias(f"{prefix}avg_seconds_to_ship"),
            F.sum(when(cond, "item_quantity")).alias(f"{prefix}total_quantity"),
            F.countDistinct(when(cond, "product_id")).alias(f"{prefix}product_cnt"),
            F.countDistinct(when(cond, "order_id")).alias(f"{prefix}total_orders"),
        ]
    return lines.groupBy("category_name").agg(*aggs)


def _counts():
    return [
        F.countDistinct("product_id").alias("prod_cnt"),
        F.countDistinct("order_id").alias("order_cnt"),
        F.countDistinct("customer_id").alias("cust_cnt"),
        F.sum("item_quantity").alias("total_qty"),
        total("item_price * item_quantity").alias("total_amt"),
    ]


def r013(t: Tables, customer: int = 79):
    """Counts and amounts of one customer."""
    lines = t["order_lineitems"].filter(F.col("customer_id") == customer)
    known = lines.join(t["products_dim"].select("product_id", "category_id"), "product_id").join(t["categories_dim"], "category_id")
    # customer_id is a constant here, so its distinct count is over one group.
    return known.groupBy("customer_id").agg(*[c for i, c in enumerate(_counts()) if i != 2]).withColumn("cust_cnt", F.lit(1).cast("bigint"))


def r015(t: Tables, category: int = 5, start: str = "1998-05-09", end: str = "1998-05-20"):
    """Counts and amounts of one category and day."""
    products = t["products_dim"].filter(F.col("category_id") == category).select("product_id", "category_id")
    lines = during(t["order_lineitems"], start, end).join(products, "product_id").join(t["categories_dim"], "category_id")
    return lines.groupBy("category_name").agg(*_counts())


def r558(t: Tables, start: str = "1998-01-01", end: str = "1998-01-31", least: int = 900):
    """Categories which sell more than `least` items."""
    sold = during(t["order_lineitems"], start, end).groupBy("product_category_id").agg(F.sum("item_quantity").alias("category_item_count"))
    return ordered(sold.filter(F.col("category_item_count") > least), "category_item_count", "product_category_id")


def basket_exclusion(t: Tables, bought: tuple[str, ...], never: tuple[str, ...]):
    """Customers who bought from one set of categories and never from another."""
    flagged = join(t["order_lineitems"], t["categories_dim"].filter(F.col("category_name").isin(*bought, *never)), "product_category_id = category_id")
    names = F.col("category_name")
    per = flagged.groupBy("customer_id").agg(
        F.sum(F.when(names.isin(*bought), F.col("item_quantity")).otherwise(0)).alias("yes"),
        F.sum(F.when(names.isin(*never), F.col("item_quantity")).otherwise(0)).alias("no"),
    )
    return per.filter("yes > 0 and no = 0").select("customer_id")


def r566(t: Tables):
    return basket_exclusion(t, ("Kitchen",), ("Digital Software", "Software"))


def r568(t: Tables):
    return basket_exclusion(t, ("CE",), ("Digital Software", "Software"))


def r573(t: Tables):
    return basket_exclusion(t, ("DVD",), ("Toys",))


def r580(t: Tables):
    return basket_exclusion(t, ("Shoes", "Apparel"), ("Furniture",))


def r582(t: Tables):
    return basket_exclusion(t, ("Beauty",), ("Home",))


def r567(t: Tables, start: str = "1998-01-01", end: str = "1998-01-31"):
    """Orders by month and shipment status."""
    lines = during(t["order_lineitems"], start, end)
    out = lines.groupBy(F.date_format("order_datetime", "yyyy/MM").alias("ship_month"), "item_shipment_status_code").agg(
        F.countDistinct("order_id").alias("num_orders"))
    return ordered(out, "ship_month", "item_shipment_status_code")


def r591(t: Tables, start: str = "1998-01-01", end: str = "1998-12-31"):
    """Orders by shipment status in a year."""
    out = during(t["order_lineitems"], start, end).groupBy("item_shipment_status_code").agg(F.countDistinct("order_id").alias("num_orders"))
    return ordered(out, "item_shipment_status_code")


def r590(t: Tables, start: str = "1998-01-01", end: str = "1998-12-31"):
    """Average number of items per customer and month."""
    per = during(t["order_lineitems"], start, end).groupBy("customer_id", F.date_format("order_datetime", "yyyy/MM").alias("m")).agg(
        F.sum("item_quantity").alias("items"))
    return per.agg(F.round(mean("items"), 2).alias("average_item_count"))


def r617(t: Tables, start: str = "1998-01-01", end: str = "1998-12-31"):
    """Average number of items per customer."""
    per = during(t["order_lineitems"], start, end).groupBy("customer_id").agg(F.sum("item_quantity").alias("items"))
    return per.agg(F.round(mean("items"), 2).alias("average_item_count"))


def r592(t: Tables, n: int = 10):
    """Top products of each category by quantity."""
    sold = t["order_lineitems"].groupBy("product_id", "product_category_id").agg(F.sum("item_quantity").alias("product_count"))
    w = W.partitionBy("product_category_id").orderBy(F.desc("product_count"), "product_id")
    out = sold.withColumn("category_rank", F.row_number().over(w)).filter(F.col("category_rank") <= n)
    return ordered(out, "product_category_id", "category_rank")


def r594(t: Tables, state: str = "CA", open_ended: bool = False):
    """Customers whose last order shipped to a state.

    The last order of each customer is found by aggregation and only it is joined
    to the address versions. A version without an end matches nothing, unless
    `open_ended` lets it run on.
    """
    last = t["order_lineitems"].groupBy("customer_id").agg(F.max("order_datetime").alias("at"))
    until = "coalesce(valid_to_timestamp, timestamp_ntz '9999-12-31')" if open_ended else "valid_to_timestamp"
    versions = t["customer_addresses_dim"].select(F.col("customer_id").alias("k"), "state_code", "valid_from_timestamp", F.expr(until).alias("until"))
    placed = join(last, versions, "customer_id = k and at between valid_from_timestamp and until")
    # Versions meet at their bounds: there the later one counts.
    newest = placed.groupBy("customer_id").agg(F.max_by("state_code", "valid_from_timestamp").alias("state_code"))
    return newest.filter(F.col("state_code") == state)


def r594_open(t: Tables):
    return r594(t, open_ended=True)


def first_last(lines, whole_frame: bool = False):
    """First and last order of each customer and category.

    Over rows ordered ascending, the default frame ends at the current row's
    peers, so "last" on the first row is the last of the earliest peers;
    `whole_frame` gives the true last order. Only the extremes of the order time
    are needed, so this is an aggregation and not a window.
    """
    keys = ["customer_id", "product_category_id"]
    if whole_frame:
        low = F.min(F.struct("order_datetime", "order_id"))
        high = F.max(F.struct("order_datetime", "order_id"))
        ends = lines.groupBy(*keys, "product_category_name").agg(low.alias("a"), high.alias("b"))
    else:
        # The earliest instant is a number and found by hashing; only its few peers are compared by order.
        first = lines.groupBy(*[F.col(k).alias(f"_{k}") for k in (*keys, "product_category_name")]).agg(F.min("order_datetime").alias("_at"))
        same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in (*keys, "product_category_name")]
        peers = lines.join(first, [*same, F.col("order_datetime").eqNullSafe(F.col("_at"))])
        ends = peers.groupBy(*keys, "product_category_name", "order_datetime").agg(F.min("order_id").alias("lo"), F.max("order_id").alias("hi")).select(
            *keys, "product_category_name", F.struct("order_datetime", F.col("lo").alias("order_id")).alias("a"), F.struct("order_datetime", F.col("hi").alias("order_id")).alias("b"))
    return ends.select(
        "customer_id", "product_category_name",
        F.col("a.order_datetime").alias("first_order_datetime"), F.col("a.order_id").alias("first_order_id"),
        F.col("b.order_datetime").alias("last_order_datetime"), F.col("b.order_id").alias("last_order_id"),
    )


def r596(t: Tables):
    return first_last(t["order_lineitems"])


def r596_whole_frame(t: Tables):
    return first_last(t["order_lineitems"], whole_frame=True)


def r597(t: Tables, product: int = 2):
    return first_last(t["order_lineitems"].filter(F.col("product_id") == product))


def r601(t: Tables, products: tuple[int, ...] = (20, 25, 29, 50, 38)):
    return first_last(t["order_lineitems"].filter(F.col("product_id").isin(*products)))


def grains(lines):
    """Quantity and price per category over three grains: whole, year, month.

    Grouping sets are (category), (category, year) and (category, month).
    """
    # Months first: the grouping sets repeat a row per category and month, not the lines.
    monthly = lines.groupBy("product_category_name", F.year("order_datetime").alias("year"), F.month("order_datetime").alias("month")).agg(
        F.sum("item_quantity").alias("item_quantity"), F.sum("item_price").alias("item_price"))
    day = F.make_date("year", "month", F.lit(1))
    dated = monthly.select("product_category_name", "item_quantity", "item_price", F.date_format(day, "yyyy").alias("y"), F.date_format(day, "yyyy-MMM").alias("m"))
    category, year, month = F.col("product_category_name"), F.col("y"), F.col("m")
    out = dated.groupingSets([[category], [category, year], [category, month]], category, year, month).agg(
        F.grouping("y").alias("gy"), F.grouping("m").alias("gm"),
        F.sum("item_quantity").alias("total_quantity"), total("item_price").alias("total_price"))
    kind = F.expr("case when gy = 0 and gm = 1 then y when gy = 1 and gm = 0 then m when gy = 1 and gm = 1 then 'Total' end")
    return out.select("product_category_name", kind.alias("type"), "total_quantity", "total_price")


def r603(t: Tables):
    return grains(t["order_lineitems"])


def r604(t: Tables, start: str = "1998-09-01", end: str = "1999-02-01"):
    return grains(during(t["order_lineitems"], start, end))


def r618(t: Tables, products: tuple[int, ...] = (20, 25, 29, 50, 38), start: str = "1998-09-01", end: str = "1999-02-01"):
    return grains(during(t["order_lineitems"], start, end).filter(F.col("product_id").isin(*products)))


def r619(t: Tables, product: int = 28, start: str = "1997-09-01", end: str = "1999-02-01"):
    return grains(during(t["order_lineitems"], start, end).filter(F.col("product_id") == product))


def r621(t: Tables, products: tuple[int, ...] = (51, 16), start: str = "1998-09-01", end: str = "1999-02-01"):
    return grains(during(t["order_lineitems"], start, end).filter(F.col("product_id").isin(*products)))


def r622(t: Tables, windows=(("1998-01-01", "1998-01-30 23:59:59"), ("1997-01-01", "1997-01-30 23:59:59")), n: int = 10, least_first: bool = True):
    """Ten products by quantity per month against the year before.

    The report ranks the least sold first; `least_first=False` gives the top.
    """
    sold = during(t["order_lineitems"], *[x for w in windows for x in w]).groupBy(F.date_format("order_datetime", "yyyy-MM").alias("order_month"), "product_id").agg(
        F.sum("item_quantity").alias("total_sold"))
    by = F.asc("total_sold") if least_first else F.desc("total_sold")
    w = W.partitionBy("order_month").orderBy(by, "product_id")
    ranked = sold.withColumn("item_rank", F.row_number().over(w)).filter(F.col("item_rank") <= n)
    out = t["products_dim"].join(F.broadcast(ranked), "product_id").select("order_month", "total_sold", "product_name", "item_rank")
    return ordered(out, "item_rank", "order_month")


def r622_top(t: Tables):
    return r622(t, least_first=False)


def r634(t: Tables, windows=(("1998-01-01", "1998-03-31 23:59:59"), ("1997-01-01", "1997-03-31 23:59:59")), days: int = 4):
    """Orders shipped later than so many days, by year."""
    late = during(t["retail_orders"], *[x for w in windows for x in w]).filter(f"ship_completion_datetime - order_datetime > interval {days} days")
    return ordered(late.groupBy(F.date_format("order_datetime", "yyyy").alias("order_year")).agg(F.count("*").alias("num_orders")), "order_year")


QUERIES = {f"retail_{n}": f for n, f in sorted(globals().items()) if n[0] == "r" and n[1:4].isdigit()}
