"""Generation of the retail star: dimensions, orders, lines, shipments.

Orders follow weekday, month and year weights; customers come and go; items per
order fall off with a power law. Everything is drawn from hashes of keys, so a
rerun, or any other partitioning, gives the same rows.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F

from tidemark.functions.distributions import Draws
from tidemark.operators.keys import dense_ids

# Relative order volumes.
DAY_WEIGHTS = {0: 16.0, 1: 24.0, 2: 16.0, 3: 14.0, 4: 10.0, 5: 8.0, 6: 12.0}  # Sunday is 0
MONTH_WEIGHTS = {1: 5.0, 2: 6.0, 3: 7.0, 4: 7.0, 5: 7.0, 6: 7.0, 7: 7.0, 8: 8.0, 9: 9.0, 10: 10.0, 11: 13.0, 12: 14.0}
YEAR_WEIGHTS = {
    1990: 45, 1991: 46, 1992: 47, 1993: 48, 1994: 48, 1995: 52, 1996: 50, 1997: 51, 1998: 55, 1999: 57, 2000: 59,
    2001: 61, 2002: 65, 2003: 69, 2004: 71, 2005: 91, 2006: 89, 2007: 91, 2008: 95, 2009: 95, 2010: 103, 2011: 111,
    2012: 120, 2013: 121, 2014: 131, 2015: 143, 2016: 147, 2017: 152, 2018: 154, 2019: 166, 2020: 170,
}
# Codes and their labels.
PAYMENT_METHODS = {1: "COD", 2: "Credit", 3: "CreditCard", 4: "GiftCertificate", 5: "FreeReplacement"}
SHIPPERS = {1: "UPS", 2: "USPS", 3: "FedEx", 4: "DHL"}
SHIPMENT_TYPES = {1: "Next Day Air", 2: "2 Day Ground", 3: "3 to 5 Day Ground", 4: "International"}
FRAUD = {"96": "Stolen Card", "97": "Compromised Account", "98": "Gift Certificate Abuse", "99": "Researching"}
FRAUD_RESOLUTION = {"5": "Resolved - Account Canceled", "6": "Resolved - No Fraud", "7": "Resolved - Order Canceled",
                    "8": "Resolved - Authorities Notified"}
CIPHER_COUPON, CIPHER_TPS, CIPHER_REF = "AKRNCPWLQV", "ikvurmsqlp", "zmeposjxya"

FIRST_ORDER_ID, FIRST_SEQUENCE = 10_000_000, 213_456_789

#: Rows of a list that every task may hold; a longer one is joined by shuffle.
LIST_ROWS = 1_000_000
#: Rows of a task that are worth one, and orders or customers of a task at most.
FEWEST_ROWS, MOST_ORDERS, MOST_PEOPLE = 10_000, 100_000, 250_000
#: Slots of orders in a task.
TASK_SLOTS = 8


@dataclass(frozen=True)
class RetailConfig:
    order_rows: int
    first_day: str = "2006-01-01"
    last_day: str = "2010-12-31"
    preload_end: str = "2010-12-09"  # about the last 2% are held out for incremental loads
    items_from: int = 1
    items_to: int = 25
    as_of: str = "2011-01-01"
    seed: int = 7


def labels(column: str, values: Mapping):
    out = F.lit(None).cast("string")
    for k, v in values.items():
        out = F.when(F.col(column) == k, F.lit(v)).otherwise(out)
    return out


def digits(x, width: int):
    """Zero-padded number; one that does not fit prints as # signs."""
    text = x.cast("bigint").cast("string")
    return F.when(F.length(text) > width, F.lit("#" * width)).otherwise(F.lpad(text, width, "0"))


def tasks_for(spark: SparkSession, rows: int, most: int) -> int:
    """Shuffle partitions for so many rows: as set, fewer for few rows, more where a task would have over `most`."""
    return max(min(int(spark.conf.get("spark.sql.shuffle.partitions")), rows // FEWEST_ROWS + 1), -(-rows // most))


# --- Dimensions ----------------------------------------------------------------


def listed(rows: DataFrame, count: int) -> DataFrame:
    """A list as a join takes it: sent to every task, unless it is too long."""
    return F.broadcast(rows) if count <= LIST_ROWS else rows


def calendar(spark: SparkSession, first: str, last: str) -> DataFrame:
    """One row per day. Bounded by the span of dates, not by the data."""
    days = spark.range(1).select(F.explode(F.expr(f"sequence(date '{first}', date '{last}')")).alias("calendar_day"))
    d = "calendar_day"
    return days.select(
        d, F.year(d).cast("smallint").alias("reporting_year"), F.quarter(d).cast("smallint").alias("reporting_quarter"),
        F.month(d).cast("smallint").alias("reporting_month"), F.weekofyear(d).cast("smallint").alias("reporting_week"),
        (F.dayofweek(d) - 1).cast("smallint").alias("reporting_dow"))


def categories(products: DataFrame) -> DataFrame:
    """Distinct category names of the product feed, numbered by name."""
    return dense_ids(products.select("category_name").distinct(), "category_id", ["category_name"])


def products(feed: DataFrame, cats: DataFrame) -> DataFrame:
    """Products with the category's key and the digits of the printed price."""
    price = F.regexp_replace("product_price", "[^0-9.]", "").cast("decimal(15,2)")
    rows = feed.join(cats, "category_name").select("category_id", price.alias("price"), "product_name")
    return dense_ids(rows, "product_id", ["product_name", "category_id", "price"])


def customers(spark: SparkSession, first_names: DataFrame, surnames: DataFrame) -> DataFrame:
    """All pairs of a first name and a surname, numbered.

    The pairs are counted off by arithmetic, customer number = first name number
    x surnames + surname number, and the names looked up by number: no product
    of the two lists is formed in one place.
    """
    firsts = dense_ids(first_names.select("first_name", "gender"), "f", ["gender", "first_name"], start=0)
    lasts = dense_ids(surnames.select("surname"), "l", ["surname"], start=0)
    n_first, n_last = firsts.count(), lasts.count()
    ids = spark.range(n_first * n_last).select(
        (F.col("id") + 1).alias("customer_id"), F.expr(f"id div {n_last}").alias("f"), F.expr(f"id % {n_last}").alias("l"))
    return ids.join(firsts, "f").join(lasts, "l").select("customer_id", "first_name", F.col("surname").alias("last_name"), "gender")


def emails(people: DataFrame, websites: DataFrame, seed: int) -> DataFrame:
    """An address at a random site for each customer."""
    sites = dense_ids(websites.select("website_name"), "site", ["website_name"])
    count = sites.count()
    pick = Draws(seed, "customer_id").whole("site", 1, count)
    return people.withColumn("site", pick).join(listed(sites, count), "site").select(
        "customer_id", F.concat_ws("@", F.concat_ws(".", "first_name", "last_name"), "website_name").alias("email_address"))


def addresses(people: DataFrame, zips: DataFrame, streets: DataFrame, cfg: RetailConfig) -> DataFrame:
    """One to fifteen address versions per customer, mostly one. A version holds
    until the next begins; the newest is open."""
    zip_rows = dense_ids(zips.select("zip_code", "city", "state"), "zip_key", ["zip_code", "city", "state"])
    street_rows = dense_ids(streets.select("street_name"), "street_key", ["street_name"])
    n_zips, n_streets = zip_rows.count(), street_rows.count()
    count = Draws(cfg.seed, "customer_id").power("address_count", 1, 15, 5).cast("int")
    d = Draws(cfg.seed, "customer_id", "version")

    def start(version: Column) -> Column:
        own = Draws(cfg.seed, "customer_id", version)
        days_ago, secs = own.whole("days", 1, 365 * 5), own.whole("secs", 1, 86400)
        return F.date_sub(F.expr(f"date '{cfg.as_of}'"), days_ago.cast("int")).cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), secs)

    # All versions of a customer are drawn in its row: the next newer one's start ends a
    # version, found in the row and not by a window, which would shuffle all versions.
    starts = F.transform(F.sequence(F.lit(1), count), lambda v: F.struct(start(v).alias("at"), v.alias("version")))
    rows = people.select("customer_id", starts.alias("_starts")).select("customer_id", "_starts", F.inline(F.col("_starts")))
    newer = F.filter("_starts", lambda s: (s["at"] > F.col("at")) | ((s["at"] == F.col("at")) & (s["version"] > F.col("version"))))
    rows = rows.select(
        "customer_id", "version", F.col("at").alias("valid_from_timestamp"), F.array_min(newer)["at"].alias("valid_to_timestamp"),
        d.whole("house", 1, 9999).cast("string").alias("house_number"),
        d.whole("street", 1, n_streets).alias("street_key"), d.whole("zip", 1, n_zips).alias("zip_key"),
        d.whole("apt", 1, 99).alias("apt"), d.whole("plus", 1, 9999).alias("plus"),
        F.concat(F.lit("("), digits(d.whole("p1", 1, 999), 3), F.lit(")"), digits(d.whole("p2", 1, 999), 3), F.lit("-"), digits(d.whole("p3", 1, 9999), 4)).alias("phone_number"))
    rows = rows.join(listed(zip_rows, n_zips), "zip_key").join(listed(street_rows, n_streets), "street_key")
    return rows.select(
        "customer_id", "version", "valid_from_timestamp", "valid_to_timestamp",
        "house_number", "street_name", F.when(F.col("apt") > 75, F.concat(F.lit("Apt "), (F.col("apt") - 75).cast("string"))).alias("appt_suite_no"),
        "city", F.col("state").alias("state_code"), "zip_code", F.concat_ws("-", "zip_code", F.col("plus").cast("string")).alias("zip_plus_four"),
        F.lit("USA").alias("country"), "phone_number")


# --- Orders ----------------------------------------------------------------------


def day_factors(spark: SparkSession, cfg: RetailConfig) -> DataFrame:
    """Relative volume of each day: the sum of its three weights, give or take about 4%."""
    days = calendar(spark, cfg.first_day, cfg.last_day)
    weight = labels_sum(days)
    noise = Draws(cfg.seed, "calendar_day").bell("noise", -4, 4, k=3, bound=False)
    return days.select("calendar_day", (weight * (1.0 + noise / 100.0)).alias("factor"))


def labels_sum(days: DataFrame):
    def lookup(column: str, weights: Mapping):
        pairs = [F.lit(x) for kv in weights.items() for x in (int(kv[0]), float(kv[1]))]
        return F.try_element_at(F.create_map(*pairs), F.col(column).cast("int"))

    parts = [lookup("reporting_dow", DAY_WEIGHTS), lookup("reporting_month", MONTH_WEIGHTS), lookup("reporting_year", YEAR_WEIGHTS)]
    return sum((F.coalesce(p, F.lit(0.0)) for p in parts), F.lit(0.0))


def day_totals(factors: DataFrame) -> DataFrame:
    return factors.agg(F.min("calendar_day").alias("first_day"), F.max("calendar_day").alias("last_day"),
                       F.max("factor").alias("max_factor"), F.sum("factor").alias("sum_factor"))


def lifetimes(people: DataFrame, cfg: RetailConfig) -> DataFrame:
    """First and last ordering day of each customer, and a segment of 1 to 10."""
    d = Draws(cfg.seed, "customer_id")
    first, last = F.expr(f"date '{cfg.first_day}'"), F.expr(f"date '{cfg.last_day}'")
    span = F.datediff(last, first)
    back = F.least(d.half_bell("joined", d.whole("joined.low", 1, 10), span, k=2, bound=False), span)
    begin = F.when(d.power("founder", 0, 10, 5) == 0, first).otherwise(F.date_sub(last, back.cast("int")))
    duration = d.power("stay", 0, 10, 5) * d.bell("stay.unit", 1, 50, k=3)
    rows = people.select("customer_id", begin.alias("start_date"), duration.cast("int").alias("days"), d.bell("segment", 1, 10).cast("smallint").alias("customer_segment"))
    end = F.when(F.col("days") == 0, last).otherwise(F.least(F.date_add("start_date", F.col("days")), last))
    return rows.select("customer_id", "start_date", end.alias("last_date"), "customer_segment")


def active_counts(lives: DataFrame, days: DataFrame) -> DataFrame:
    """Active customers per day, from arrivals and departures: customers are
    counted by date and never spread over their days for it."""
    moves = lives.groupBy(F.col("start_date").alias("day")).agg(F.count("*").alias("n")).unionByName(
        lives.groupBy(F.date_add("last_date", 1).alias("day")).agg((-F.count("*")).alias("n")))
    per_day = days.select(F.col("calendar_day").alias("day"), F.lit(0).cast("bigint").alias("n")).unionByName(moves).groupBy("day").agg(F.sum("n").alias("n"))
    # One row per day of the calendar.
    running = F.sum("n").over(W.orderBy("day").rowsBetween(W.unboundedPreceding, W.currentRow))
    return per_day.select(F.col("day").alias("calendar_day"), running.alias("active"))


#: Steps of the line of chances, in expected orders of one customer.
CHANCE_STEP = 0.01


def daily_customers(lives: DataFrame, factors: DataFrame, cfg: RetailConfig) -> DataFrame:
    """Who orders on which day, thinned to about the wanted number of orders.

    The chances of the days, one after another, form a line. A customer's stretch of it,
    from the first to the last day, is as long as the orders expected of that customer.
    Points lie on it at steps of one from a drawn offset, and the day under a point has an
    order: each day with its chance, and as that is one at most, never twice. Work follows
    the orders, not the days that customers live through.
    """
    whole = factors.agg(F.sum("factor")).scalar()
    chance = factors.join(active_counts(lives, factors), "calendar_day").select(
        F.col("calendar_day").alias("day"), F.coalesce(F.least(F.try_divide(F.lit(float(cfg.order_rows)) * F.col("factor") / whole, F.col("active")), F.lit(1.0)), F.lit(0.0)).alias("p"))
    # One row per day of the calendar.
    line = chance.withColumn("upto", F.sum("p").over(W.orderBy("day").rowsBetween(W.unboundedPreceding, W.currentRow))).withColumn("since", F.col("upto") - F.col("p"))
    ends = [F.broadcast(line.select(F.col("day").alias("start_date"), F.col("since").alias("from_chance"))), F.broadcast(line.select(F.col("day").alias("last_date"), F.col("upto").alias("to_chance")))]
    rows = lives.join(ends[0], "start_date").join(ends[1], "last_date").withColumn("wanted", F.col("to_chance") - F.col("from_chance"))
    own = Draws(cfg.seed, "customer_id")
    rows = rows.withColumn("offset", own.whole("at", 0, 999_999_999) / 1_000_000_000).withColumn("points", F.ceil(F.col("wanted") - F.col("offset")).cast("int"))
    rows = rows.filter("points > 0").select(
        "customer_id", "customer_segment", "from_chance", "offset", F.explode(F.sequence(F.lit(0), F.col("points") - 1)).alias("point"))
    at = F.col("from_chance") + F.col("offset") + F.col("point")
    # Days by the steps of the line that they touch: a day and its neighbours share a step.
    step = F.lit(CHANCE_STEP)
    days = line.filter("p > 0").select("day", "since", "upto", F.explode(F.sequence(F.floor(F.col("since") / step), F.floor(F.col("upto") / step))).alias("step"))
    found = rows.withColumn("at", at).withColumn("step", F.floor(F.col("at") / step)).join(F.broadcast(days), "step").filter("at >= since and at < upto")
    return found.select(F.col("day").alias("calendar_day"), "customer_id", "customer_segment").distinct()


def order_base(daily: DataFrame, cfg: RetailConfig) -> DataFrame:
    """Numbered orders with their printed numbers, store, payment and size."""
    d = Draws(cfg.seed, "calendar_day", "customer_id")
    rows = daily.select(
        "*", d.whole("big", 1, 9_999_999_999).alias("bigrand"), d.bell("store", 1, 100).cast("smallint").alias("store_id"),
        d.whole("pay", 1, 5).cast("smallint").alias("payment_method_id"),
        d.power("items", cfg.items_from, cfg.items_to, 16).cast("smallint").alias("item_count"),
        d.whole("clock", 0, 86399).alias("clock"))
    rows = dense_ids(rows, "order_id", ["calendar_day", "customer_id"], start=FIRST_ORDER_ID)
    seq = F.col("order_id") - FIRST_ORDER_ID + FIRST_SEQUENCE
    rows = rows.withColumn("bigseq", seq).withColumn("order_ts", F.expr("cast(calendar_day as timestamp_ntz) + make_dt_interval(0, 0, 0, clock)"))
    number = F.concat(F.lit("ON"), digits(F.expr("order_id div 100000"), 5), F.lit("-"), digits(F.expr("order_id % 100000"), 5), F.lit("-"),
                      digits(F.expr("bigseq % 100"), 2), F.lit("-"), digits(F.expr("bigrand % 1000000"), 6))
    session = F.concat(F.lit("OS"), digits(F.expr("bigseq % 100000"), 5), F.lit("-"), digits(F.expr("(bigrand * 13 div 100) % 1000000"), 6), F.lit("-"),
                       digits(F.col("customer_segment"), 2), F.lit("-"), digits(F.expr("customer_id % 100000"), 5))
    return rows.drop("clock").withColumns({"order_num": number, "ordering_session_id": session})


def order_items(orders: DataFrame, product_rows: int, cfg: RetailConfig) -> DataFrame:
    """One row per item. The item number is the order's number times the largest
    item count plus the position: unique, with gaps, and without a shuffle."""
    rows = orders.select("*", F.explode(F.sequence(F.lit(cfg.items_from), F.col("item_count").cast("int"))).alias("item_ctr"))
    d = Draws(cfg.seed, "calendar_day", "customer_id", "item_ctr")

    def after(name: str, low: int, high: int):
        return F.expr("cast(calendar_day as timestamp_ntz)") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), d.bell(name, low, high, k=3, bound=False))

    return rows.select(
        "*", (F.col("order_id") * (cfg.items_to + 1) + F.col("item_ctr")).alias("order_item_id"),
        d.bell("status", 1, 10).cast("smallint").alias("status_code"), d.bell("product", 1, product_rows).alias("product_id"),
        after("ship", 86400, 604800).alias("ship_ts"),
        F.when(~d.flag("kept", 0.9), after("return", 604800, 2592000)).alias("item_return_ts"),
        F.when(~d.flag("unrefunded", 0.966), after("refund", 604800, 2592000)).alias("item_refund_ts"),
        d.power("quantity", 1, 25, 15).cast("smallint").alias("item_quantity"),
        d.power("discount", 1, 25, 15).cast("smallint").alias("discount_code"),
        d.half_bell("coupon", 1, 10).cast("smallint").alias("coupon_no"))


def cipher(x, alphabet: str):
    return F.translate(x.cast("string"), "0123456789", alphabet)


ITEM = ("order_id", "order_item_id", "status_code", "product_id", "ship_ts", "item_return_ts", "item_refund_ts", "item_quantity", "discount_code", "coupon_no")


def line_items(orders: DataFrame, items: DataFrame, prods: DataFrame, cats: DataFrame, people: DataFrame, addrs: DataFrame, mails: DataFrame, taxes: DataFrame) -> DataFrame:
    """Order lines with the attributes of product, customer, address and tax.

    What depends on the customer is joined to the orders, what depends on the product to the
    bare items. The two meet in slots of orders whose numbers follow one another, under
    `layout.joins_by_some_keys` without a further shuffle. Numbers follow time, so the lines
    come out gathered by time, and whole lines are never shuffled.
    """
    profile = (
        people.join(addrs.filter("valid_to_timestamp is null"), "customer_id").join(mails, "customer_id").join(F.broadcast(taxes), "state_code")
    )
    goods = prods.join(cats, "category_id")
    n = orders.count()
    tasks = tasks_for(orders.sparkSession, n, MOST_ORDERS)
    slot = F.expr(f"(order_id - {FIRST_ORDER_ID}) div {max(1, -(-n // (tasks * TASK_SLOTS)))}")
    bought = items.select(*ITEM).join(goods, "product_id")
    rows = orders.join(profile, "customer_id").withColumn("_slot", slot).repartition(tasks, "_slot").join(
        bought.withColumn("_slot", slot).repartition(tasks, "_slot"), ["_slot", "order_id"])
    quantity = F.expr("case when item_quantity > 12 then item_quantity - 11 else 1 end")
    big, customer = F.col("bigrand"), F.col("customer_id")
    coupon = (
        F.when(F.col("coupon_no") == 1, "BOGO-PDX").when(F.col("coupon_no") == 2, "None").when(F.col("coupon_no") == 3, "HOLIDAY")
        .when(F.col("coupon_no") == 4, F.concat(F.lit("Coupon-"), cipher(big, CIPHER_COUPON))).otherwise(F.concat(F.lit("CUST-Ret-"), cipher(customer, CIPHER_COUPON)))
    )
    url = F.concat(
        F.lit("http://retail.example.com/product_detail/"), F.translate("category_name", " ", "_"), F.lit("/?tps="), cipher(big, CIPHER_TPS),
        F.lit("&sessionid="), F.col("ordering_session_id"), F.lit("&ref="), cipher(customer, CIPHER_REF), F.lit("&sku="), F.col("product_id").cast("string"))
    name = F.concat_ws(" ", "first_name", "last_name")
    return rows.select(
        F.col("order_id").cast("string").alias("order_id"), "order_item_id", "product_id", "product_name", "customer_id", "store_id",
        F.expr("case when status_code < 3 then 'Received' when status_code = 3 then 'Prep' when status_code = 4 then 'Shipper_Notified' else 'Shipped' end").alias("item_shipment_status_code"),
        F.col("order_ts").alias("order_datetime"), F.col("ship_ts").alias("ship_datetime"),
        F.col("item_return_ts").alias("item_return_datetime"), F.col("item_refund_ts").alias("item_refund_datetime"),
        F.col("category_id").alias("product_category_id"), F.col("category_name").alias("product_category_name"),
        labels("payment_method_id", PAYMENT_METHODS).alias("payment_method_code"),
        (quantity * F.col("price") * F.col("tax_rate") / 100).cast("decimal(15,5)").alias("tax_amount"),
        quantity.cast("int").alias("item_quantity"), F.col("price").cast("decimal(10,2)").alias("item_price"),
        F.expr("cast(case discount_code when 1 then 0.05 when 2 then 0 else 0.05 + 0.015 * discount_code end as decimal(15,5))").alias("discount_amount"),
        coupon.alias("coupon_code"),
        F.expr("cast(case coupon_no when 1 then 0.5 when 2 then 0 when 3 then 0.15 when 4 then 0.1 * item_quantity else 0.05 end as decimal(15,5))").alias("coupon_amount"),
        F.concat_ws(" ", "house_number", "street_name").alias("ship_address_line1"), F.col("appt_suite_no").alias("ship_address_line2"),
        F.when(F.substring(big.cast("string"), 1, 2).cast("int") >= 76, F.concat(F.lit("ATTN: "), name)).alias("ship_address_line3"),
        F.col("city").alias("ship_address_city"), F.col("state_code").alias("ship_address_state"), F.col("zip_code").alias("ship_address_postal_code"),
        F.col("country").alias("ship_address_country"), F.col("phone_number").alias("ship_phone_number"), name.alias("ship_customer_name"),
        F.col("email_address").alias("ship_customer_email_address"), "ordering_session_id", url.alias("website_url"))


def orders_of(lines: DataFrame) -> DataFrame:
    """Orders as groups of their lines, with cancel, return, refund and fraud marks."""
    def yes(cond: str):
        return F.when(F.expr(cond), "Y").otherwise("N")

    biggest = {
        "customer_id": "customer_id", "store_id": "store_id", "ship_datetime": "ship_completion_datetime", "payment_method_code": "payment_method_code",
        "coupon_code": "coupon_code", "coupon_amount": "coupon_amount", "ordering_session_id": "ordering_session_id", "website_url": "website_url",
        "ship_phone_number": "billing_phone_number", "ship_customer_name": "customer_name", "ship_customer_email_address": "customer_email_address",
        **{f"ship_address_{c}": f"billing_address_{c}" for c in ("line1", "line2", "line3", "city", "state", "postal_code", "country")},
    }
    out = lines.groupBy("order_id").agg(
        *[F.max(c).alias(n) for c, n in biggest.items()],
        F.min("order_datetime").alias("order_datetime"), F.min("item_return_datetime").alias("return_datetime"), F.min("item_refund_datetime").alias("refund_datetime"),
        F.sum("tax_amount").alias("total_tax_amount"), F.sum(F.expr("item_quantity * item_price")).cast("decimal(15,5)").alias("total_paid_amount"),
        F.sum("item_quantity").alias("total_item_quantity"), F.sum("discount_amount").alias("total_discount_amount"),
        yes("count_if(item_return_datetime is not null or item_refund_datetime is not null) = count(*)").alias("order_canceled_flag"),
        yes("max(item_return_datetime) is not null").alias("has_returned_items_flag"), yes("max(item_refund_datetime) is not null").alias("has_refunded_items_flag"))
    out = out.withColumns({"_mark": F.substring("order_id", 2, 2), "_step": F.substring("order_id", 6, 1)})
    solved = F.when(F.col("_mark") > "95", F.coalesce(labels("_step", FRAUD_RESOLUTION), F.lit("In Progress")))
    return out.withColumns({"fraud_code": labels("_mark", FRAUD), "fraud_resolution_code": solved}).drop("_mark", "_step")


def shipments(lines: DataFrame, cfg: RetailConfig) -> DataFrame:
    """Shipped lines with shipper, service and the split of the shipping cost."""
    d = Draws(cfg.seed, "order_item_id")
    number = F.concat_ws("-", digits(F.expr("order_item_id div 100000"), 5), digits(F.expr("order_item_id % 100000"), 5), digits(F.expr("product_id % 100"), 2),
                         digits(((F.col("product_id") * d.bell("parcel", 3, 37)) / 100).cast("bigint") % 1000000, 6))
    address = [c for c in lines.columns if c.startswith("ship_") and c != "ship_datetime"]
    rows = lines.filter("ship_datetime is not null").withColumns({"_by": d.whole("shipper", 1, 4), "_kind": d.whole("type", 1, 4)})
    cost = "cast(5 + 0.03 * item_price as decimal(15,5))"
    return rows.select(
        number.alias("shipment_id"), "order_id", "order_item_id", "product_id", "product_name", "customer_id", "order_datetime", "ship_datetime",
        F.col("item_quantity").alias("item_ship_quantity"), "item_price",
        F.expr(f"cast(0.8 * {cost} as decimal(10,2))").alias("customer_paid_ship_cost"), F.expr(f"cast(0.2 * {cost} as decimal(10,2))").alias("our_paid_ship_cost"),
        labels("_by", SHIPPERS).alias("shipper_code"), labels("_kind", SHIPMENT_TYPES).alias("shipment_type_code"), *address)


def split_preload(frame: DataFrame, column: str, cfg: RetailConfig) -> tuple[DataFrame, DataFrame]:
    """Rows for the first load, and those held out for incremental loads."""
    bound = F.expr(f"timestamp_ntz '{cfg.preload_end}'")
    return frame.filter(F.col(column) < bound), frame.filter(F.col(column) >= bound)


def seeds_from(stored: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """Seed lists taken from a stored TPC-H-like set; they grow with its tables."""
    part, customer, supplier = stored["part"], stored["customer"], stored["supplier"]
    states = F.element_at(F.array(*[F.lit(s) for s in ("TN", "GA", "TX", "OH", "KY", "NM", "VA", "CA")]), (F.col("s_suppkey") % 8 + 1).cast("int"))
    return {
        "first_names": stored["nation"].select(F.concat(F.lit("First"), F.col("n_nationkey").cast("string")).alias("first_name"),
                                               F.when(F.col("n_nationkey") % 2 == 0, "M").otherwise("F").alias("gender")),
        "surnames": customer.select(F.substring("c_name", 10, 9).alias("surname")),
        "products": part.select(F.concat_ws(" ", "p_type", F.element_at(F.split("p_name", " "), -1)).alias("category_name"),
                                F.concat_ws(" ", "p_name", F.col("p_partkey").cast("string")).alias("product_name"),
                                F.concat(F.lit("$"), F.format_number("p_retailprice", 2)).alias("product_price")),
        "websites": supplier.select(F.concat(F.lower(F.regexp_replace("s_name", "[^A-Za-z0-9]", "")), F.lit(".example.com")).alias("website_name")),
        "zips": supplier.select(F.lpad((F.col("s_suppkey") * 37 % 100000).cast("string"), 5, "0").alias("zip_code"),
                                F.concat(F.lit("City "), (F.col("s_suppkey") % 40).cast("string")).alias("city"), states.alias("state")),
        "streets": supplier.select(F.concat(F.lit("Street "), F.col("s_suppkey").cast("string")).alias("street_name")),
        "taxes": supplier.select(states.alias("state_code")).distinct().withColumn("tax_rate", (F.lit(4) + F.ascii("state_code") % 5).cast("decimal(5,3)")),
    }
