"""Registered jobs: loads, layouts, checks, streams, draws and star generation."""

from __future__ import annotations

from dataclasses import replace
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.functions.columns import exact_total
from tidemark.functions.distributions import Draws
from tidemark.operators import validate
from tidemark.plans import retail_star, tpch
from tidemark.plans.star_tables import FACTS, StarStore
from tidemark.sources import layout, load
from tidemark.sources.schemas import STORED
from tidemark.sources.shared import new_folder
from tidemark.sources.spans import SpanFact
from tidemark.sources.tables import StoredTables, colocated_tables, create_views, tpch_tables
from tidemark.streaming import loads, snapshots, windows

# --- Loads and layouts -----------------------------------------------------------------

LINE = STORED["lineitem"]


def _text_lineitem(spark: SparkSession, sf: str, fmt=load.PIPE) -> str:
    """Line items as delimited text in which some lines are spoilt: every order
    number divisible by 500 gets a word for its quantity."""
    rows = StoredTables(spark, sf)["lineitem"]
    spoilt = rows.withColumn("l_quantity", F.when(F.col("l_orderkey") % 500 == 0, "many").otherwise(F.col("l_quantity").cast("string")))
    path = new_folder(spark, "lineitem-text")
    load.unload(spoilt, path, fmt)
    return path


def _totals(rows: DataFrame) -> DataFrame:
    return rows.groupBy("l_returnflag").agg(F.count("*").alias("n"), exact_total("l_extendedprice", 2).alias("price"), F.max("l_shipdate").alias("last_ship"))


def load_delimited(spark: SparkSession, sf: str) -> DataFrame:
    """Bulk copy of pipe-separated text with a percent limit and an error table."""
    source, target = _text_lineitem(spark, sf), new_folder(spark, "loaded")
    name = target.rsplit("/", 1)[1].replace("-", "_")
    load.load(spark, source, LINE, name, limit_percent=100, error_table=f"{name}_errors", table_path=target, error_path=new_folder(spark, "errors"))
    bad = spark.table(f"{name}_errors").agg(F.lit("rejected").alias("l_returnflag"), F.count("*").alias("n"), F.lit(None).cast("double").alias("price"),
                                            F.lit(None).cast("timestamp_ntz").alias("last_ship"))
    return _totals(spark.table(name)).unionByName(bad)


def load_csv(spark: SparkSession, sf: str) -> DataFrame:
    """The same from comma-separated text, read without a table."""
    return _totals(load.accepted(load.read_delimited(spark, _text_lineitem(spark, sf, load.CSV), LINE, load.CSV)))


def load_rejects(spark: SparkSession, sf: str) -> DataFrame:
    """Accepted and rejected rows over all files."""
    rows = load.read_delimited(spark, _text_lineitem(spark, sf), LINE)
    return load.reject_counts(rows).agg(F.sum("good").alias("good"), F.sum("bad").alias("bad"))


def load_nulls(spark: SparkSession, sf: str) -> DataFrame:
    """Text in which an empty field means null."""
    stored = StoredTables(spark, sf)
    rows = stored["orders"].withColumn("o_orderpriority", F.when(F.col("o_orderkey") % 3 == 0, None).otherwise(F.col("o_orderpriority")))
    path = new_folder(spark, "orders-text")
    load.unload(rows, path, load.PIPE_NULLS)
    back = load.accepted(load.read_delimited(spark, path, STORED["orders"], load.PIPE_NULLS))
    return back.groupBy("o_orderpriority").agg(F.count("*").alias("n"), exact_total("o_totalprice", 2).alias("price"))


def _stored_as(spark: SparkSession, sf: str, table: str, how: layout.Layout, rows: DataFrame | None = None) -> DataFrame:
    path = new_folder(spark, table)
    name = path.rsplit("/", 1)[1].replace("-", "_")
    layout.write_table(StoredTables(spark, sf)[table] if rows is None else rows, name, how, path=path)
    return spark.table(name)


def layout_slices(spark: SparkSession, sf: str) -> DataFrame:
    """Partitioning by equal slices of the calendar."""
    rows = StoredTables(spark, sf)["lineitem"].withColumn("slice", layout.slice_of("l_shipdate", 14, "1995-01-01", "2001-12-31"))
    stored = _stored_as(spark, sf, "lineitem", layout.Layout(partition_by=("slice",)), rows)
    return stored.groupBy("slice").agg(F.count("*").alias("n"), F.min("l_shipdate").alias("first_ship"), F.max("l_shipdate").alias("last_ship"))


def layout_twenty_days(spark: SparkSession, sf: str) -> DataFrame:
    """Partitioning by slices of twenty days, read back for two of them."""
    rows = StoredTables(spark, sf)["orders"].withColumn("slice", layout.width_slice("o_orderdate", 20, "1995-01-01"))
    stored = _stored_as(spark, sf, "orders", layout.Layout(partition_by=("slice",), codec="ZSTD"), rows)
    return stored.filter("slice in (40, 41)").groupBy("slice").agg(F.count("*").alias("n"), exact_total("o_totalprice", 2).alias("price"))


def layout_months(spark: SparkSession, sf: str) -> DataFrame:
    """Monthly partitions; the reader turns a time range into months to scan."""
    rows = StoredTables(spark, sf)["orders"].withColumn("order_month", layout.month_of("o_orderdate"))
    stored = _stored_as(spark, sf, "orders", layout.Layout(orientation="COLUMN", codec="ZLIB", partition_by=("order_month",)), rows)
    start, end = "1998-03-15", "1998-05-10"
    hit = stored.filter(layout.within_months("order_month", start, end)).filter(f"o_orderdate between timestamp_ntz '{start}' and timestamp_ntz '{end}'")
    return hit.groupBy("order_month").agg(F.count("*").alias("n"), exact_total("o_totalprice", 2).alias("price"))


def layout_colocated(spark: SparkSession, sf: str) -> DataFrame:
    """Two facts bucketed by the order key: their join needs no exchange."""
    t = colocated_tables(spark, sf)
    both = t["lineitem"].hint("merge").join(t["orders"], F.expr("l_orderkey = o_orderkey"))
    return both.groupBy("o_orderpriority").agg(F.count("*").alias("n"), exact_total("l_quantity", 2).alias("quantity"))


def layout_random(spark: SparkSession, sf: str) -> DataFrame:
    """Rows spread evenly over files, with table statistics gathered."""
    path = new_folder(spark, "part")
    name = path.rsplit("/", 1)[1].replace("-", "_")
    part = StoredTables(spark, sf)["part"]
    layout.write_table(part, name, layout.Layout(random_files=layout.parts_for(part), codec="GZIP"), path=path)
    layout.analyze(spark, name, "p_partkey", "p_size", bins=64)
    return spark.table(name).groupBy("p_size").agg(F.count("*").alias("n"))


def layout_history(spark: SparkSession, sf: str) -> DataFrame:
    """Events of two of four runs moved to history, loaded and moved again."""
    name = new_folder(spark, "events").rsplit("/", 1)[1].replace("-", "_")
    how = layout.Layout(partition_by=("run_id",))
    rows = StoredTables(spark, sf)["events"].withColumn("run_id", (F.col("event_id") % 4).cast("int"))
    layout.write_table(rows, name, how)
    layout.move_to_history(spark, name, f"{name}_history", "run_id", 1, 2, "first")
    layout.write_table(rows.filter("run_id = 1"), name, how, mode="append")
    layout.move_to_history(spark, name, f"{name}_history", "run_id", 1, 1, "second")
    left = spark.table(name).groupBy("run_id").agg(F.lit("left").alias("batch_id"), F.count("*").alias("n"))
    return spark.table(f"{name}_history").groupBy("run_id", "batch_id").agg(F.count("*").alias("n")).unionByName(left)


def layout_literal(spark: SparkSession, sf: str) -> DataFrame:
    """Orders by a dimension given as literal rows."""
    names = layout.literal_table(spark, [("O", "open"), ("F", "filled"), ("P", "partly filled")], "o_orderstatus string, status_name string")
    orders = StoredTables(spark, sf)["orders"].join(F.broadcast(names), "o_orderstatus")
    return orders.groupBy("status_name").agg(F.count("*").alias("n"), exact_total("o_totalprice", 2).alias("price"))


def layout_view(spark: SparkSession, sf: str) -> DataFrame:
    """A view over line items, joined to suppliers in SQL."""
    t = tpch_tables(spark, sf)
    create_views({"revenue": tpch.revenue_by_supplier(t), "revenue_supplier": t["supplier"]})
    return spark.sql("select s_nationkey, count(*) as suppliers, max(total_revenue) as best from revenue_supplier join revenue on supplier_no = s_suppkey group by s_nationkey")


# --- Checks -------------------------------------------------------------------------------


def check_difference(spark: SparkSession, sf: str) -> DataFrame:
    """Orders against a copy with some totals changed and some rows doubled."""
    rows = StoredTables(spark, sf)["orders"].select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate")
    other = rows.withColumn("o_totalprice", F.when(F.col("o_orderkey") % 1000 == 7, F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice")))
    other = other.unionByName(rows.filter("o_orderkey % 2000 = 11"))
    return validate.difference(rows, other, ignore=("o_orderdate",))


def check_digest(spark: SparkSession, sf: str) -> DataFrame:
    return validate.digest(StoredTables(spark, sf)["orders"].select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority", "o_orderdate"), ignore=("o_orderdate",))


def check_priority(spark: SparkSession, sf: str) -> DataFrame:
    """An answer comes before a digest: the verdict on orders, and on a changed copy of them."""
    rows = StoredTables(spark, sf)["orders"].select("o_orderkey", "o_custkey", "o_totalprice")
    other = rows.withColumn("o_totalprice", F.when(F.col("o_orderkey") % 1000 == 7, F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice")))
    out = None
    for name, answer in (("same", rows), ("changed", other)):
        found = validate.check(rows, answer, expected_digest=(0, 0))
        line = found.diff.agg(F.lit(name).alias("copy"), F.lit(found.status).alias("status"), F.lit(found.how).alias("how"), F.count("*").alias("differing"))
        out = line if out is None else out.unionByName(line)
    return out


def check_row_counts(spark: SparkSession, sf: str) -> DataFrame:
    t = StoredTables(spark, sf)
    return validate.row_counts({n: t[n] for n in ("lineitem", "orders", "part")}, {"lineitem": 1000, "orders": 1000, "part": 100})


# --- Streams --------------------------------------------------------------------------------

EVENTS = STORED["events"]


def stream_append(spark: SparkSession, sf: str) -> DataFrame:
    """Micro-batches of event files appended and counted."""
    source, target = new_folder(spark, "event-files"), new_folder(spark, "appended")
    StoredTables(spark, sf)["events"].repartition(6, "event_id").write.parquet(source)
    loads.append_batches(loads.file_stream(spark, source, EVENTS, files_per_batch=2), target, new_folder(spark, "checkpoint"))
    return loads.running_counts(spark, target).agg(F.sum("rows").alias("rows"), F.max("running").alias("running"))


def stream_load(spark: SparkSession, sf: str) -> DataFrame:
    """Continuous load of delimited files with rejects."""
    target = new_folder(spark, "streamed")
    loads.load_batches(loads.delimited_stream(spark, _text_lineitem(spark, sf), LINE, files_per_batch=4), target, new_folder(spark, "checkpoint"), limit_percent=50)
    bad = spark.read.schema(load.REJECTS).parquet(f"{target}/rejects").agg(
        F.lit("rejected").alias("l_returnflag"), F.count("*").alias("n"), F.lit(None).cast("double").alias("price"), F.lit(None).cast("timestamp_ntz").alias("last_ship"))
    return _totals(spark.read.schema(LINE).parquet(f"{target}/rows")).unionByName(bad)


def _event_stream(spark: SparkSession, sf: str) -> DataFrame:
    events, folder = StoredTables(spark, sf)["events"], new_folder(spark, "event-files")
    events.write.parquet(folder)
    windows.close_input(events, "ts", folder)
    rows = loads.file_stream(spark, folder, EVENTS)
    return rows.withColumn("ts", F.col("ts").cast("timestamp")).withColumn("host", F.concat(F.lit("w"), (F.col("user_id") % 8).cast("string")))


def _finished(spark: SparkSession, stream: DataFrame) -> DataFrame:
    target = new_folder(spark, "windows")
    windows.to_files(stream, target, new_folder(spark, "checkpoint"))
    out = spark.read.schema(stream.schema).parquet(target)
    times = [f.name for f in out.schema.fields if f.dataType.typeName() == "timestamp"]
    return out.withColumns({c: F.col(c).cast("timestamp_ntz") for c in times})


def stream_tumbling(spark: SparkSession, sf: str) -> DataFrame:
    """Five-minute peaks per host."""
    return _finished(spark, windows.telemetry_windows(_event_stream(spark, sf), "ts", "host", "value"))


def stream_sliding(spark: SparkSession, sf: str) -> DataFrame:
    """Hourly windows every half hour."""
    return _finished(spark, windows.telemetry_windows(_event_stream(spark, sf), "ts", "host", "value", "1 hour", "30 minutes"))


def stream_spans(spark: SparkSession, sf: str) -> DataFrame:
    """Sessions closed by an hour without a snapshot."""
    return _finished(spark, windows.activity_spans(_event_stream(spark, sf), "ts", "user_id", "1 hour"))


def stream_snapshots(spark: SparkSession, sf: str) -> DataFrame:
    """Spans of sessions by the difference of a monitor's snapshots, eight monitors; what runs in the last stays open."""
    events, folder = StoredTables(spark, sf)["events"], new_folder(spark, "snapshots")
    # a snapshot of a quarter of an hour lists the sessions seen in it
    seen = events.select((F.col("user_id") % 8).alias("monitor"), F.date_trunc("HOUR", "ts").alias("hour"), F.minute("ts").alias("minute"), F.col("user_id").alias("sess_id"),
                         F.col("event_type").alias("user_name"))
    rows = seen.select("monitor", (F.col("hour") + F.make_dt_interval(mins=F.floor(F.col("minute") / 15).cast("int") * 15)).alias("at"), "sess_id", F.lit(1).cast("long").alias("query_no"), "user_name")
    rows.write.parquet(folder)
    windows.close_input(rows, "at", folder)
    stream = loads.file_stream(spark, folder, "monitor long, at timestamp_ntz, sess_id long, query_no long, user_name string").withColumn("at", F.col("at").cast("timestamp"))
    return _finished(spark, snapshots.spans_of_snapshots(stream, "at", "monitor"))


# --- Draws ------------------------------------------------------------------------------------


def draws_of(rows: DataFrame, key: str, seed: int = 7) -> DataFrame:
    d = Draws(seed, key)
    return rows.select(
        key, d.normal("normal", 50.0, 10.0).alias("normal"), d.bell("bell", 1, 100).cast("double").alias("bell"),
        d.bell("bell3", 1, 50, k=3).cast("double").alias("bell_3"), d.two_bells("two", 1, 100, 201, 300).cast("double").alias("two_bells"),
        d.half_bell("half", 1, 10).cast("double").alias("half_bell"), d.power("power", 1, 25, 15).cast("double").alias("power"),
        d.whole("whole", 1, 6).cast("double").alias("whole"), d.flag("flag", 0.25).cast("int").cast("double").alias("flag"))


DRAWN = ("normal", "bell", "bell_3", "two_bells", "half_bell", "power", "whole", "flag")


def draws_bounds(spark: SparkSession, sf: str) -> DataFrame:
    """Per distribution: draws, the least, the greatest and the sum, to six digits."""
    rows = draws_of(StoredTables(spark, sf)["orders"], "o_orderkey")
    long = rows.select(F.explode(F.create_map(*[x for n in DRAWN for x in (F.lit(n), F.col(n))])).alias("name", "x")).withColumn("x", F.col("x").cast("decimal(18,6)"))
    return long.groupBy("name").agg(F.count("*").alias("draws"), *[f("x").cast("double").alias(n) for f, n in ((F.min, "least"), (F.max, "greatest"), (F.sum, "total"))])


def draws_histogram(spark: SparkSession, sf: str) -> DataFrame:
    """How often each whole number is drawn."""
    rows = draws_of(StoredTables(spark, sf)["orders"], "o_orderkey").drop("normal")
    long = rows.select(F.explode(F.create_map(*[x for n in DRAWN if n != "normal" for x in (F.lit(n), F.col(n))])).alias("name", "x"))
    return long.groupBy("name", "x").agg(F.count("*").alias("n"))


# --- Star generation -----------------------------------------------------------------------------


_stars: dict[tuple[str, str], StarStore] = {}


def _star(spark: SparkSession, sf: str) -> StarStore:
    """The star of a data folder, stored once per application."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _stars:
        stored = StoredTables(spark, sf)
        _stars[key] = StarStore(spark, retail_star.seeds_from(stored), retail_star.RetailConfig(order_rows=stored["orders"].count()))
    return _stars[key]


def star_products(spark: SparkSession, sf: str) -> DataFrame:
    return _star(spark, sf).table("products").withColumn("price", F.col("price").cast("double"))


def star_calendar(spark: SparkSession, sf: str) -> DataFrame:
    return _star(spark, sf).table("calendar")


def star_customers(spark: SparkSession, sf: str) -> DataFrame:
    return _star(spark, sf).table("customers")


def star_addresses(spark: SparkSession, sf: str) -> DataFrame:
    """All address versions; the newest is open, the others end where the next begins."""
    return _star(spark, sf).table("addresses")


def star_emails(spark: SparkSession, sf: str) -> DataFrame:
    return _star(spark, sf).table("emails")


def star_lifetimes(spark: SparkSession, sf: str) -> DataFrame:
    return _star(spark, sf).table("lifetimes")


def star_ciphers(spark: SparkSession, sf: str) -> DataFrame:
    """Printed numbers, ciphers and cut names of customers."""
    people = StoredTables(spark, sf)["customer"]
    return people.select("c_custkey", retail_star.digits(F.col("c_custkey"), 5).alias("printed"), retail_star.cipher(F.col("c_custkey"), retail_star.CIPHER_COUPON).alias("cipher"),
                         F.expr("substring(c_name from 10 for 4)").alias("cut"))


def star_days(spark: SparkSession, sf: str) -> DataFrame:
    """Each day's factor, the orders its weights call for, and those drawn."""
    star = _star(spark, sf)
    factors = star.table("day_factors")
    whole = retail_star.day_totals(factors)
    drawn = star.table("daily").groupBy("calendar_day").agg(F.count("*").alias("drawn"))
    wanted = F.round(F.col("factor") / F.col("sum_factor") * star.cfg.order_rows, 6)
    return factors.crossJoin(F.broadcast(whole)).join(drawn, "calendar_day").select("calendar_day", F.round("factor", 6).alias("factor"), wanted.alias("wanted"), "drawn")


def star_order_base(spark: SparkSession, sf: str) -> DataFrame:
    """Numbered orders with their printed numbers."""
    return _star(spark, sf).table("orders_base").select(
        "order_id", "calendar_day", "customer_id", "customer_segment", "store_id", "payment_method_id", "item_count", "order_ts", "order_num", "ordering_session_id")


def star_items(spark: SparkSession, sf: str) -> DataFrame:
    """Items of the orders, with what was drawn for each."""
    return _star(spark, sf).table("items").select(
        "order_item_id", "order_id", "item_ctr", "status_code", "product_id", "ship_ts", "item_return_ts", "item_refund_ts", "item_quantity", "discount_code", "coupon_no")


def star_orders(spark: SparkSession, sf: str) -> DataFrame:
    """Orders per year and payment, from lines grouped back to orders."""
    return _star(spark, sf).whole("orders").groupBy(F.year("order_datetime").alias("year"), "payment_method_code").agg(
        F.count("*").alias("orders"), F.sum("total_item_quantity").alias("items"), F.sum("total_paid_amount").cast("double").alias("paid"),
        F.count(F.when(F.col("has_returned_items_flag") == "Y", 1)).alias("with_returns"), F.count("fraud_code").alias("frauds"))


def star_line_items(spark: SparkSession, sf: str) -> DataFrame:
    """Lines per category and status, preloaded and held out."""
    star = _star(spark, sf)
    rows = star.fact("lines").rows().withColumn("part", F.lit("preload")).unionByName(star.held_out("lines").withColumn("part", F.lit("later")))
    return rows.groupBy("part", "product_category_name", "item_shipment_status_code").agg(
        F.count("*").alias("n"), F.sum("item_quantity").alias("quantity"), F.sum("tax_amount").cast("double").alias("tax"))


def star_coupons(spark: SparkSession, sf: str) -> DataFrame:
    """Coupon and discount of each line."""
    return _star(spark, sf).whole("lines").select("order_item_id", "coupon_code", F.col("coupon_amount").cast("double"), F.col("discount_amount").cast("double"))


def star_shipments(spark: SparkSession, sf: str) -> DataFrame:
    return _star(spark, sf).whole("shipments").groupBy("shipper_code", "shipment_type_code").agg(F.count("*").alias("n"), F.sum("customer_paid_ship_cost").cast("double").alias("paid"))


def star_months(spark: SparkSession, sf: str) -> DataFrame:
    """A range of time over months and weeks of the stored lines."""
    rows = _star(spark, sf).fact("lines").rows("2009-11-20 12:00:00", "2010-02-03 00:00:00")
    return rows.groupBy(F.date_format("order_datetime", "yyyy-MM").alias("month")).agg(F.count("*").alias("n"), F.sum("item_quantity").alias("quantity"))


def _by_span(name: str, fact: SpanFact) -> DataFrame:
    quantity = {"lines": "item_quantity", "orders": "total_item_quantity", "shipments": "item_ship_quantity"}[name]
    return fact.stored().groupBy(F.lit(name).alias("fact"), "span").agg(F.count("*").alias("n"), F.sum(quantity).alias("quantity"))


def star_replay(spark: SparkSession, sf: str) -> DataFrame:
    """The first load and the replayed rest of the three facts, by span."""
    star, fresh = _star(spark, sf), new_folder(spark, "replay")
    return reduce(DataFrame.unionByName, [_by_span(n, star.replayed(n, 3, fresh)) for n in FACTS])


def star_rolled(spark: SparkSession, sf: str) -> DataFrame:
    """Replayed lines after time has gone on: weeks have become months, and most of the open span weeks."""
    fact = _star(spark, sf).replayed("lines", 2, new_folder(spark, "rolled"))
    fact.roll_over(replace(fact.grains(), monthly_end="2010-07-01", weekly_end="2010-12-25"))
    return _by_span("lines", fact)


NAMES = ("load_", "layout_", "check_", "stream_", "draws_", "star_")
QUERIES = {n: f for n, f in sorted(globals().items()) if n.startswith(NAMES) and callable(f) and n != "draws_of"}
