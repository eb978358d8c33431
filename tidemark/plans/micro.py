"""Micro-queries: each stresses one operator of the engine (scan, aggregation,
join, CPU, point and range access)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions.columns import exact_mean, exact_total, ordered
from tidemark.plans.tpch import Tables, join, not_in
from tidemark.sources.layout import Layout, parts_for, write_table
from tidemark.sources.shared import new_folder

REVENUE = "l_extendedprice * (1 - l_discount)"


def x01(t: Tables):
    """Scan whose filter matches nothing: row groups are skipped by min/max."""
    return t["lineitem"].filter("l_linenumber < 0")


def x01_full(t: Tables, line: int = 7):
    """The same scan with a filter that does match."""
    return t["lineitem"].filter(F.col("l_linenumber") >= line).select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_shipdate", "l_commitdate")


def insert_select(t: Tables, table: str, layout: Layout):
    """Writes part into a new table below the shared folder and reads it back."""
    spark = t["part"].sparkSession
    path = new_folder(spark, table)
    name = path.rsplit("/", 1)[1].replace("-", "_")
    write_table(t["part"], name, layout, path=path)
    return spark.table(name)


def x02(t: Tables):
    """Insert-select into a table bucketed by the source's own key."""
    return insert_select(t, "part_by_key", Layout(buckets=parts_for(t["part"]), bucket_by=("p_partkey",)))


def x03(t: Tables):
    """Insert-select into a table bucketed by three other columns."""
    return insert_select(t, "part_by_shape", Layout(buckets=parts_for(t["part"]), bucket_by=("p_size", "p_brand", "p_container")))


def x04(t: Tables):
    return t["lineitem"].agg(F.count("*").alias("row_count"))


def x05(t: Tables):
    return t["lineitem"].agg(F.countDistinct("l_quantity").alias("quantities"))


def x06(t: Tables):
    return t["orders"].groupBy("o_orderstatus", "o_orderpriority").agg(exact_mean("o_totalprice").alias("avg_o_totalprice"))


def x07(t: Tables):
    return ordered(t["lineitem"].groupBy("l_receiptdate").agg(F.count("*").alias("num")), "l_receiptdate")


def x08(t: Tables, width: int = 22):
    return t["orders"].groupBy(F.substring("o_comment", 1, width).alias("substring_comment")).agg(F.count("*").alias("num"))


def x09(t: Tables):
    """Join of two facts on the key both are distributed by."""
    return join(t["lineitem"], t["orders"], "l_orderkey = o_orderkey").agg(exact_mean("l_quantity").alias("avg_quantity"))


def x10(t: Tables):
    sold = join(t["lineitem"], t["part"], "l_partkey = p_partkey")
    return sold.agg(exact_mean("p_retailprice * l_quantity").alias("avg_total_price"))


def x11(t: Tables):
    """Join of unrelated keys. Lines are summed per key first, so that a hot
    supplier is one row in the join."""
    per_key = t["lineitem"].groupBy("l_suppkey").agg(exact_total("l_quantity", 2).alias("q"))
    return join(per_key, t["part"].select("p_partkey"), "l_suppkey = p_partkey").agg(exact_total("q", 2).alias("total_quantity"))


def x12(t: Tables):
    people = join(t["customer"], F.broadcast(t["nation"]), "c_nationkey = n_nationkey")
    return people.groupBy("n_name").agg(exact_mean("c_acctbal").alias("avg_acctbal"))


def x13(t: Tables):
    """Customers whose key is NOT IN those of the orders."""
    idle = not_in(t["customer"], t["orders"].select("o_custkey"), "c_custkey", "o_custkey")
    return idle.agg(exact_total("c_acctbal", 2).alias("total_acctbal"))


def x14(t: Tables, today: str = "2002-01-01"):
    """Many expressions per row: seven grouping keys and twelve aggregates."""
    lines = t["lineitem"].filter("l_linenumber > 2")
    return lines.groupBy(
        "l_returnflag", "l_linestatus", "l_shipmode",
        F.substring("l_shipinstruct", 1, 1).alias("instruct_initial"),
        F.substring("l_linestatus", 1, 1).alias("status_initial"),
        F.expr("l_quantity - l_linenumber + (l_linenumber - l_quantity)").alias("zero_quantity"),
        F.expr("l_extendedprice - l_extendedprice").alias("zero_price"),
    ).agg(
        exact_total("(1 + l_tax) * l_extendedprice").alias("taxed"),
        exact_total(REVENUE).alias("revenue"),
        exact_total("l_discount / 3", 8).alias("third_discount"),
        exact_total(f"{REVENUE} * (1 + l_tax)", 6).alias("charge"),
        exact_total(f"l_extendedprice - {REVENUE}").alias("rebate"),
        F.sum(F.expr(f"datediff(date '{today}', l_shipdate) + 5")).alias("age_days"),
        F.sum(F.expr("datediff(l_shipdate, l_commitdate)")).alias("ship_lag"),
        F.sum(F.expr("datediff(l_receiptdate, l_shipdate)")).alias("transit"),
        F.sum(F.expr("l_linenumber + 15 - 14")).alias("line_sum"),
        exact_total("l_extendedprice / (10 - l_tax)", 8).alias("price_tenth"),
        exact_total("l_quantity * 2 / (l_linenumber * 3)", 8).alias("quantity_share"),
        F.count("*").alias("n"),
    )


def x15(t: Tables, today: str = "2002-01-01"):
    big = [1.1e4, 2.1e4, 3.1e4, 4.1e4, 5.1e4, 6.1e4, 7.1e4, 8.1e4, 9.1e4, 50.0]
    return (
        t["lineitem"].filter(F.col("l_quantity").isin(big))
        .filter(f"datediff(date '{today}', l_shipdate) > 0")
        .filter("date_add(l_commitdate, 5) < date_add(l_receiptdate, 5) and date_add(l_shipdate, 20) < date_add(l_commitdate, 20)")
        .agg(F.count("*").alias("n"))
    )


def x16(t: Tables, key: int = 5000, price: float = 909.0):
    return t["part"].filter((F.col("p_partkey") < key) & (F.col("p_retailprice") < price)).select("p_name", "p_retailprice")


def x17(t: Tables, day: str = "1995-12-01"):
    return t["lineitem"].filter(f"l_shipdate < date '{day}'").select("l_orderkey", "l_linenumber")


def x18(t: Tables, prefix: str = "Clerk#0000006"):
    return t["orders"].filter(F.col("o_clerk").startswith(prefix)).select("o_clerk").distinct()


def x19(t: Tables, start: str = "1996-03-01", end: str = "1996-03-31"):
    return t["lineitem"].filter(f"l_shipdate between date '{start}' and date '{end}'").select("l_quantity").distinct()


def x20(t: Tables, clerk: str = "Clerk#000000670", key: int = 505):
    return t["orders"].filter((F.col("o_clerk") == clerk) | (F.col("o_orderkey") == key)).agg(F.count("*").alias("n"))


def x21(t: Tables):
    return t["lineitem"].groupBy("l_discount").agg(F.count("*").alias("n"))


def x22(t: Tables, kind: str = "SMALL PLATED BRASS"):
    return t["part"].filter(F.col("p_type") == kind).agg(exact_mean("p_retailprice").alias("avg_price"))


def x23(t: Tables, size: int = 21):
    return t["part"].filter(F.col("p_size") == size).agg(exact_mean("p_retailprice").alias("avg_price"))


#: Queries that read base tables distributed by key.
COLOCATED = {"micro_x09"}
QUERIES = {f"micro_{n}": f for n, f in sorted(globals().items()) if n[0] == "x" and callable(f)}
