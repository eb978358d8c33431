"""TPC-H, query by query, over the tables of `tpch_tables` or a stored TPC-H set.

Every function takes a mapping of table name to DataFrame; the literals are
keyword arguments.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, functions as F

from tidemark.functions.columns import (
    col, exact, exact_mean, exact_total, ordered, total, when,
)

Tables = Mapping[str, DataFrame]

REVENUE = "l_extendedprice * (1 - l_discount)"


def join(left: DataFrame, right: DataFrame, on: str, how: str = "inner") -> DataFrame:
    return left.join(right, F.expr(on), how)


def not_in(left: DataFrame, right: DataFrame, key: str, other: str) -> DataFrame:
    """Rows of `left` whose key is NOT IN the column `other` of `right`, as SQL has it: none
    where that column holds a null, and those without a key only where `right` has no rows.
    Both are asked of a scan that the files' statistics, or its first row, end."""
    nulls = right.filter(F.col(other).isNull()).limit(1).agg(F.count("*")).scalar()
    rows = right.limit(1).agg(F.count("*")).scalar()
    return join(left, right, f"{key} = {other}", "left_anti").filter((nulls == 0) & (F.col(key).isNotNull() | (rows == 0)))


def nations_of(t: Tables, region: str) -> DataFrame:
    """The nations of one region (25 rows at any scale, so broadcast)."""
    return F.broadcast(join(t["nation"], t["region"].filter(F.col("r_name") == region), "n_regionkey = r_regionkey"))


def q01(t: Tables, until: str = "2001-09-27") -> DataFrame:
    out = (
        t["lineitem"].filter(f"l_shipdate <= date '{until}'")
        .groupBy("l_returnflag", "l_linestatus")
        .agg(
            exact_total("l_quantity", 2).alias("sum_qty"),
            exact_total("l_extendedprice", 2).alias("sum_base_price"),
            exact_total(REVENUE).alias("sum_disc_price"),
            exact_total(f"{REVENUE} * (1 + l_tax)", 6).alias("sum_charge"),
            exact_mean("l_quantity").alias("avg_qty"),
            exact_mean("l_extendedprice").alias("avg_price"),
            exact_mean("l_discount").alias("avg_disc"),
            F.count("*").alias("count_order"),
        )
    )
    return ordered(out, "l_returnflag", "l_linestatus")


def q02(t: Tables, size: int = 25, metal: str = "COPPER", region: str = "MIDDLE EAST") -> DataFrame:
    parts = t["part"].filter(F.col("p_size").between(size, size + 9) & F.col("p_type").like(f"%{metal}"))
    supply = join(join(t["supplier"], nations_of(t, region), "s_nationkey = n_nationkey"), t["partsupp"], "s_suppkey = ps_suppkey")
    offers = join(parts, supply, "p_partkey = ps_partkey")
    cheapest = offers.groupBy(F.col("ps_partkey").alias("k")).agg(F.min("ps_supplycost").alias("low"))
    best = join(offers, cheapest, "ps_partkey = k and ps_supplycost = low")
    out = best.select("s_acctbal", "s_name", "n_name", "p_partkey", "p_mfgr", "s_address", "s_phone", "s_comment")
    return ordered(out, "-s_acctbal", "n_name", "s_name", "p_partkey", limit=100)


def q03(t: Tables, segment: str = "FURNITURE", day: str = "1998-03-26") -> DataFrame:
    buyers = t["customer"].filter(F.col("c_mktsegment") == segment).select("c_custkey")
    open_orders = join(t["orders"].filter(f"o_orderdate < date '{day}'"), buyers, "o_custkey = c_custkey", "left_semi")
    lines = t["lineitem"].filter(f"l_shipdate > date '{day}'")
    out = (
        join(lines, open_orders, "l_orderkey = o_orderkey")
        .groupBy("l_orderkey", "o_orderdate", "o_shippriority").agg(exact_total(REVENUE).alias("revenue"))
    )
    return ordered(out, "-revenue", "o_orderdate", "l_orderkey", limit=10)


def q04(t: Tables, start: str = "1997-02-01") -> DataFrame:
    quarter = t["orders"].filter(f"o_orderdate >= date '{start}' and o_orderdate < add_months(date '{start}', 3)")
    late = t["lineitem"].filter("l_commitdate < l_receiptdate").select("l_orderkey")
    out = join(quarter, late, "o_orderkey = l_orderkey", "left_semi").groupBy("o_orderpriority").agg(F.count("*").alias("order_count"))
    return ordered(out, "o_orderpriority")


def q05(t: Tables, region: str = "ASIA", start: str = "1997-01-01") -> DataFrame:
    orders = t["orders"].filter(f"o_orderdate >= date '{start}' and o_orderdate < add_months(date '{start}', 12)")
    sellers = join(t["supplier"], nations_of(t, region), "s_nationkey = n_nationkey").select("s_suppkey", "s_nationkey", "n_name")
    buyers = join(orders, t["customer"], "o_custkey = c_custkey").select("o_orderkey", "c_nationkey")
    sold = join(t["lineitem"], sellers, "l_suppkey = s_suppkey")
    out = (
        join(sold, buyers, "l_orderkey = o_orderkey and s_nationkey = c_nationkey")
        .groupBy("n_name").agg(exact_total(REVENUE).alias("revenue"))
    )
    return ordered(out, "-revenue")


def q06(t: Tables, start: str = "1997-01-01", discount: float = 0.06, quantity: int = 24) -> DataFrame:
    low, high = round(discount - 0.01, 2), round(discount + 0.01, 2)
    return (
        t["lineitem"]
        .filter(f"l_shipdate >= date '{start}' and l_shipdate < add_months(date '{start}', 12)")
        .filter(F.col("l_discount").between(low, high) & (F.col("l_quantity") < quantity))
        .agg(exact_total("l_extendedprice * l_discount").alias("revenue"))
    )


def q07(t: Tables, one: str = "NATION_3", two: str = "NATION_8", start: str = "1997-01-01", end: str = "1998-12-31") -> DataFrame:
    pair = F.broadcast(t["nation"].filter(F.col("n_name").isin(one, two)).select("n_nationkey", "n_name"))
    sellers = join(t["supplier"], pair, "s_nationkey = n_nationkey").select("s_suppkey", F.col("n_name").alias("supp_nation"))
    buyers = join(t["customer"], pair, "c_nationkey = n_nationkey").select("c_custkey", F.col("n_name").alias("cust_nation"))
    orders = join(t["orders"], buyers, "o_custkey = c_custkey").select("o_orderkey", "cust_nation")
    lines = join(t["lineitem"].filter(f"l_shipdate between date '{start}' and date '{end}'"), sellers, "l_suppkey = s_suppkey")
    out = (
        join(lines, orders, "l_orderkey = o_orderkey and supp_nation <> cust_nation")
        .groupBy("supp_nation", "cust_nation", F.year("l_shipdate").alias("l_year"))
        .agg(exact_total(REVENUE).alias("revenue"))
    )
    return ordered(out, "supp_nation", "cust_nation", "l_year")


def q08(t: Tables, nation: str = "NATION_5", region: str = "AFRICA", kind: str = "STANDARD ANODIZED TIN",
        start: str = "1997-01-01", end: str = "1998-12-31") -> DataFrame:
    parts = t["part"].filter(F.col("p_type") == kind).select("p_partkey")
    buyers = join(t["customer"], nations_of(t, region), "c_nationkey = n_nationkey").select("c_custkey")
    orders = join(t["orders"].filter(f"o_orderdate between date '{start}' and date '{end}'"), buyers, "o_custkey = c_custkey")
    sellers = join(t["supplier"], F.broadcast(t["nation"]), "s_nationkey = n_nationkey").select("s_suppkey", "n_name")
    lines = join(join(t["lineitem"], parts, "l_partkey = p_partkey"), orders, "l_orderkey = o_orderkey")
    out = (
        join(lines, sellers, "l_suppkey = s_suppkey")
        .groupBy(F.year("o_orderdate").alias("o_year"))
        .agg(F.try_divide(exact_total(F.when(F.col("n_name") == nation, col(REVENUE)).otherwise(F.lit(0.0))), exact_total(REVENUE)).alias("mkt_share"))
    )
    return ordered(out, "o_year")


def q09(t: Tables, word: str = "blue") -> DataFrame:
    parts = t["part"].filter(F.col("p_name").contains(word)).select("p_partkey")
    sellers = join(t["supplier"], F.broadcast(t["nation"]), "s_nationkey = n_nationkey").select("s_suppkey", F.col("n_name").alias("nation"))
    lines = join(join(t["lineitem"], parts, "l_partkey = p_partkey"), t["partsupp"], "l_partkey = ps_partkey and l_suppkey = ps_suppkey")
    dated = join(join(lines, sellers, "l_suppkey = s_suppkey"), t["orders"], "l_orderkey = o_orderkey")
    amount = f"{REVENUE} - cast(ps_supplycost as double) * l_quantity"
    out = dated.groupBy("nation", F.year("o_orderdate").alias("o_year")).agg(exact_total(amount).alias("sum_profit"))
    return ordered(out, "nation", "-o_year")


def q10(t: Tables, start: str = "1997-07-01") -> DataFrame:
    orders = t["orders"].filter(f"o_orderdate >= date '{start}' and o_orderdate < add_months(date '{start}', 3)")
    returned = t["lineitem"].filter("l_returnflag = 'R'")
    # The customer's attributes depend on the key: group by it alone, then attach them.
    lost = join(returned, orders, "l_orderkey = o_orderkey").groupBy("o_custkey").agg(exact_total(REVENUE).alias("revenue"))
    people = join(t["customer"], F.broadcast(t["nation"]), "c_nationkey = n_nationkey")
    out = join(people, lost, "c_custkey = o_custkey").select(
        "c_custkey", "c_name", "revenue", "c_acctbal", "n_name", "c_address", "c_phone", "c_comment")
    return ordered(out, "-revenue", "c_custkey", limit=20)


def q11(t: Tables, nation: str = "NATION_7", fraction: float = 0.0005) -> DataFrame:
    here = join(t["supplier"], F.broadcast(t["nation"].filter(F.col("n_name") == nation)), "s_nationkey = n_nationkey")
    stock = join(t["partsupp"], here, "ps_suppkey = s_suppkey", "left_semi").select(
        "ps_partkey", exact("ps_supplycost * ps_availqty", 2).alias("worth"))
    whole = stock.agg((total("worth") * F.lit(fraction)).alias("x")).scalar()
    out = stock.groupBy("ps_partkey").agg(total("worth").alias("value")).filter(F.col("value") > whole)
    return ordered(out, "-ps_partkey", "-value")


def q12(t: Tables, modes: tuple[str, ...] = ("REG AIR", "FOB"), start: str = "1997-01-01") -> DataFrame:
    lines = t["lineitem"].filter(
        F.col("l_shipmode").isin(*modes)
        & F.expr("l_commitdate < l_receiptdate and l_shipdate < l_commitdate")
        & F.expr(f"l_receiptdate >= date '{start}' and l_receiptdate < add_months(date '{start}', 12)")
    )
    urgent = "o_orderpriority in ('1-URGENT', '2-HIGH')"
    out = join(lines, t["orders"], "l_orderkey = o_orderkey").groupBy("l_shipmode").agg(
        F.sum(F.expr(f"case when {urgent} then 1 else 0 end")).alias("high_line_count"),
        F.sum(F.expr(f"case when {urgent} then 0 else 1 end")).alias("low_line_count"),
    )
    return ordered(out, "l_shipmode")


def q13(t: Tables, pattern: str = "%express%deposits%") -> DataFrame:
    # Counting orders per customer before the join keeps a hot customer small.
    per_customer = t["orders"].filter(~F.col("o_comment").like(pattern)).groupBy("o_custkey").agg(F.count("*").alias("n"))
    counts = join(t["customer"], per_customer, "c_custkey = o_custkey", "left").select(F.coalesce("n", F.lit(0)).alias("c_count"))
    out = counts.groupBy("c_count").agg(F.count("*").alias("custdist"))
    return ordered(out, "-custdist", "-c_count")


def q14(t: Tables, start: str = "1997-04-01") -> DataFrame:
    month = t["lineitem"].filter(f"l_shipdate >= date '{start}' and l_shipdate < add_months(date '{start}', 1)")
    sold = join(month, t["part"], "l_partkey = p_partkey")
    promo = F.when(F.col("p_type").startswith("PROMO"), col(REVENUE)).otherwise(F.lit(0.0))
    return sold.agg(F.try_divide(100.0 * exact_total(promo), exact_total(REVENUE)).alias("promo_revenue"))


def revenue_by_supplier(t: Tables, start: str = "1997-04-01") -> DataFrame:
    """The revenue view: each supplier's revenue of ninety days."""
    window = t["lineitem"].filter(f"l_shipdate >= date '{start}' and l_shipdate < date_add(date '{start}', 90)")
    return window.groupBy(F.col("l_suppkey").alias("supplier_no")).agg(exact_total(REVENUE).alias("total_revenue"))


def q15(t: Tables, start: str = "1997-04-01") -> DataFrame:
    revenue = revenue_by_supplier(t, start)
    best = revenue.filter(F.col("total_revenue") == revenue.agg(F.max("total_revenue")).scalar())
    out = join(t["supplier"], best, "s_suppkey = supplier_no").select("s_suppkey", "s_name", "s_address", "s_phone", "total_revenue")
    return ordered(out, "s_suppkey")


def q16(t: Tables, brand: str = "Brand#15", kind: str = "ECONOMY BURNISHED",
        sizes: tuple[int, ...] = (9, 6, 45, 44, 47, 21, 14, 42)) -> DataFrame:
    parts = t["part"].filter((F.col("p_brand") != brand) & ~F.col("p_type").startswith(kind) & F.col("p_size").isin(*sizes))
    blamed = t["supplier"].filter(F.col("s_comment").like("%Customer%Complaints%")).select("s_suppkey")
    clean = not_in(t["partsupp"], blamed, "ps_suppkey", "s_suppkey")
    out = join(clean, parts, "ps_partkey = p_partkey").groupBy("p_brand", "p_type", "p_size").agg(
        F.countDistinct("ps_suppkey").alias("supplier_cnt"))
    return ordered(out, "-supplier_cnt", "p_brand", "p_type", "p_size")


def q17(t: Tables, brand: str = "Brand#5", container: str = "JUMBO CASE") -> DataFrame:
    parts = t["part"].filter((F.col("p_brand") == brand) & (F.col("p_container") == container)).select("p_partkey")
    lines = join(t["lineitem"], parts, "l_partkey = p_partkey")
    typical = lines.groupBy(F.col("p_partkey").alias("k")).agg((0.2 * exact_mean("l_quantity")).alias("bound"))
    small = join(lines, typical, "p_partkey = k and l_quantity < bound")
    return small.agg((exact_total("l_extendedprice", 2) / 7.0).alias("avg_yearly"))


def q18(t: Tables, quantity: int = 250) -> DataFrame:
    # The orders are found and their quantities summed in one pass over the lines.
    big = t["lineitem"].groupBy("l_orderkey").agg(exact_total("l_quantity", 2).alias("total_quantity")).filter(F.col("total_quantity") > quantity)
    placed = join(t["orders"], big, "o_orderkey = l_orderkey")
    out = join(placed, t["customer"], "o_custkey = c_custkey").select(
        "c_name", "c_custkey", "o_orderkey", "o_orderdate", "o_totalprice", "total_quantity")
    return ordered(out, "-o_totalprice", "-total_quantity", "o_orderdate", "c_name", "c_custkey", "o_orderkey", limit=100)


BANDS = (  # brand, containers, least quantity, largest size
    ("Brand#1", ("SM CASE", "SM BOX"), 2, 30),
    ("Brand#2", ("MED BAG", "MED BOX"), 10, 40),
    ("Brand#3", ("LG CASE", "LG BOX"), 20, 50),
)


def q19(t: Tables, bands=BANDS, modes: tuple[str, ...] = ("AIR", "REG AIR")) -> DataFrame:
    lines = t["lineitem"].filter(F.col("l_shipmode").isin(*modes) & (F.col("l_shipinstruct") == "DELIVER IN PERSON"))
    sold = join(lines, t["part"], "l_partkey = p_partkey")
    match = F.lit(False)
    for brand, containers, least, size in bands:
        match = match | (
            (F.col("p_brand") == brand) & F.col("p_container").isin(*containers)
            & F.col("l_quantity").between(least, least + 10) & F.col("p_size").between(1, size)
        )
    return sold.filter(match).agg(exact_total(REVENUE).alias("revenue"))


def q20(t: Tables, prefix: str = "blue", start: str = "1997-01-01", nation: str = "NATION_4") -> DataFrame:
    parts = t["part"].filter(F.col("p_name").startswith(prefix)).select("p_partkey")
    offers = join(t["partsupp"], parts, "ps_partkey = p_partkey", "left_semi")
    year = t["lineitem"].filter(f"l_shipdate >= date '{start}' and l_shipdate < add_months(date '{start}', 12)")
    sold = year.groupBy("l_partkey", "l_suppkey").agg((0.5 * exact_total("l_quantity", 2)).alias("half"))
    ample = join(offers, sold, "ps_partkey = l_partkey and ps_suppkey = l_suppkey and ps_availqty > half")
    here = join(t["supplier"], F.broadcast(t["nation"].filter(F.col("n_name") == nation)), "s_nationkey = n_nationkey")
    out = join(here, ample, "s_suppkey = ps_suppkey", "left_semi").select("s_name", "s_address")
    return ordered(out, "s_name")


def q21(t: Tables, nation: str = "NATION_4") -> DataFrame:
    """Orders with several suppliers of which exactly one was late.

    Both EXISTS tests compare suppliers within one order, so the least and the
    greatest supplier, over all and over late lines, decide them in one pass.
    """
    late = "l_receiptdate > l_commitdate"
    per_order = t["lineitem"].groupBy("l_orderkey").agg(
        F.min("l_suppkey").alias("lo"), F.max("l_suppkey").alias("hi"),
        F.min(when(late, "l_suppkey")).alias("late_lo"), F.max(when(late, "l_suppkey")).alias("late_hi"),
        F.count(when(late, "1")).alias("late_lines"),
    )
    alone = per_order.filter("lo <> hi and late_lo = late_hi")
    failed = join(alone, t["orders"].filter("o_orderstatus = 'F'"), "l_orderkey = o_orderkey", "left_semi")
    here = join(t["supplier"], F.broadcast(t["nation"].filter(F.col("n_name") == nation)), "s_nationkey = n_nationkey")
    out = join(failed, here, "late_lo = s_suppkey").groupBy("s_name").agg(F.sum("late_lines").alias("numwait"))
    return ordered(out, "-numwait", "s_name", limit=100)


def q22(t: Tables, codes: tuple[str, ...] = ("15", "29", "27", "17", "31", "22", "19")) -> DataFrame:
    people = t["customer"].withColumn("cntrycode", F.substring("c_phone", 1, 2)).filter(F.col("cntrycode").isin(*codes))
    usual = people.filter("c_acctbal > 0.00").agg(exact_mean("c_acctbal")).scalar()
    idle = join(people.filter(F.col("c_acctbal") > usual), t["orders"], "c_custkey = o_custkey", "left_anti")
    out = idle.groupBy("cntrycode").agg(F.count("*").alias("numcust"), exact_total("c_acctbal", 2).alias("totacctbal"))
    return ordered(out, "cntrycode")


QUERIES = {f"tpch_{n}": f for n, f in sorted(globals().items()) if n.startswith("q") and callable(f)}
