"""The stored retail star: how its facts are made, written and copied."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemark.plans import retail_star, star_tables
from tidemark.plans.star_tables import StarStore
from tidemark.sources.layout import joins_by_some_keys
from tidemark.sources.shared import new_folder, subfolders
from tidemark.sources.spans import SpanFact
from tidemark.streaming import replay

SMALL = "spark.sql.autoBroadcastJoinThreshold"


def small_star(spark):
    stored = {
        "nation": spark.range(5).select(F.col("id").alias("n_nationkey")),
        "customer": spark.range(40).select(F.format_string("Customer#%09d", "id").alias("c_name")),
        "supplier": spark.range(9).select(F.col("id").alias("s_suppkey"), F.format_string("Supplier#%09d", "id").alias("s_name")),
        "part": spark.range(60).select(F.col("id").alias("p_partkey"), F.concat(F.lit("blue "), F.col("id") % 3).alias("p_name"), F.concat(F.lit("TYPE "), F.col("id") % 4).alias("p_type"),
                                       (F.col("id") * 1.25 + 900).alias("p_retailprice")),
    }
    return StarStore(spark, retail_star.seeds_from(stored), retail_star.RetailConfig(order_rows=3000))


@pytest.fixture(scope="module")
def star(spark):
    return small_star(spark)


def rows_of(frame):
    return sorted(map(str, frame.select(sorted(frame.columns)).collect()))


def stages_of_jobs(spark, group):
    tracker = spark.sparkContext.statusTracker()
    return [len(tracker.getJobInfo(j).stageIds) for j in tracker.getJobIdsForGroup(group)]


def test_lines_are_stored_once_and_alone(star):
    star.fact("lines")
    assert not {"all_lines", "items", "addresses", "emails"} & set(subfolders(star.spark, star.folder))
    want = retail_star.line_items(star.table("orders_base"), star.table("items"), star.table("products"), star.table("categories"), star.table("customers"), star.table("addresses"),
                                  star.table("emails"), star.seeds["taxes"])
    assert rows_of(star.whole("lines")) == rows_of(want) and star.whole("lines").count() > 3000


def test_whole_lines_are_not_shuffled(spark, star):
    before = spark.conf.get(SMALL)
    spark.conf.set(SMALL, "-1")
    try:
        with joins_by_some_keys(spark):
            plan = star_tables.FACT_MAKERS["lines"][0](star)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set(SMALL, before)
    assert "SortMergeJoin [_slot" in plan and "Exchange" not in plan.split("SortMergeJoin [_slot")[0]
    assert plan.count("Exchange hashpartitioning(_slot") == 2


def test_coupons_of_all_lines_lie_in_the_fact_or_are_held_out(star):
    coupons = lambda lines: rows_of(lines.select("order_item_id", "coupon_code", "coupon_amount", "discount_amount"))
    bound = dt.datetime.fromisoformat(star.cfg.preload_end)
    first, later = star.fact("lines").rows(), star.held_out("lines")
    assert first.agg(F.max("order_datetime")).first()[0] < bound <= later.agg(F.min("order_datetime")).first()[0]
    assert sorted(coupons(first) + coupons(later)) == coupons(star.whole("lines"))
    days = {str(r[0]) for r in later.select(F.col("order_datetime").cast("date")).distinct().collect()}
    assert replay.days_held(star.spark, f"{star.folder}/held-out/lines") == sorted(f"{replay.DAY}={d}" for d in days)


def test_shipments_are_made_where_lines_lie(spark, star):
    star.fact("lines")
    spark.sparkContext.setJobGroup(group := new_folder(spark, "group"), "")
    star.fact("shipments")
    spark.sparkContext.setJobGroup("", "")
    assert "all_shipments" not in subfolders(spark, star.folder) and set(stages_of_jobs(spark, group)) == {1}
    assert rows_of(star.whole("shipments")) == rows_of(retail_star.shipments(star.whole("lines"), star.cfg))


def test_a_fact_is_copied_without_a_shuffle(spark, star, monkeypatch):
    star.fact("lines")
    made, group = SpanFact.create, new_folder(spark, "group")

    def create(*args, **named):
        spark.sparkContext.setJobGroup(group, "")
        try:
            return made(*args, **named)
        finally:
            spark.sparkContext.setJobGroup("", "")

    monkeypatch.setattr(SpanFact, "create", staticmethod(create))
    copy = star.replayed("lines", 2, new_folder(spark, "copy"))
    assert set(stages_of_jobs(spark, group)) == {1}
    assert rows_of(copy.rows()) == rows_of(star.whole("lines"))


def test_all_facts_are_replayed(star):
    fresh = new_folder(star.spark, "fresh")
    for name in ("orders", "shipments"):
        assert rows_of(star.replayed(name, 3, fresh).rows()) == rows_of(star.whole(name))
    assert rows_of(star.whole("orders")) == rows_of(retail_star.orders_of(star.whole("lines")))
    assert "all_orders" not in subfolders(star.spark, star.folder)


def test_emails_and_addresses_by_long_lists(spark, star, monkeypatch):
    """Lists too long to be sent to every task give the same rows."""
    made = lambda: (rows_of(retail_star.emails(star.table("customers"), star.seeds["websites"], 7)),
                    rows_of(retail_star.addresses(star.table("customers"), star.seeds["zips"], star.seeds["streets"], star.cfg)))
    want = made()
    monkeypatch.setattr(retail_star, "LIST_ROWS", 0)
    assert made() == want
