"""Draws: ranges, shapes, and independence of partitioning."""

from pyspark.sql import functions as F

from tidemark.functions.distributions import Draws
from tidemark.plans import retail_star

N = 20000


def column(spark, make, partitions=4):
    rows = spark.range(N).repartition(partitions)
    return {r.id: r.x for r in rows.select("id", make(Draws(7, "id")).alias("x")).collect()}


def test_draws_do_not_depend_on_partitions(spark):
    make = lambda d: d.bell("a", 1, 100)
    assert column(spark, make, 1) == column(spark, make, 7)


def test_draws_differ_by_name_and_seed(spark):
    rows = spark.range(1000).select(Draws(7, "id").uniform("a").alias("a"), Draws(7, "id").uniform("b").alias("b"), Draws(8, "id").uniform("a").alias("c"))
    got = rows.agg(F.corr("a", "b"), F.corr("a", "c"), F.min("a"), F.max("a")).first()
    assert abs(got[0]) < 0.1 and abs(got[1]) < 0.1 and 0 <= got[2] < got[3] < 1


def test_normal(spark):
    x = list(column(spark, lambda d: d.normal("n", 50.0, 10.0)).values())
    mean = sum(x) / N
    dev = (sum((v - mean) ** 2 for v in x) / N) ** 0.5
    assert abs(mean - 50) < 0.4 and abs(dev - 10) < 0.3


def test_bell_stays_inside_and_unbounded_does_not(spark):
    x = list(column(spark, lambda d: d.bell("b", 10, 20, k=1)).values())
    assert min(x) == 10 and max(x) == 20 and abs(sum(x) / N - 15) < 0.15
    y = list(column(spark, lambda d: d.bell("b", 10, 20, k=1, bound=False)).values())
    assert min(y) < 10 and max(y) > 20


def test_bell_falls_back_to_the_middle(spark):
    # No draw rounds into an empty range, so all ten fail.
    assert set(column(spark, lambda d: d.bell("b", 20, 10)).values()) == {15}


def test_two_bells(spark):
    x = list(column(spark, lambda d: d.two_bells("t", 1, 100, 201, 300)).values())
    assert not [v for v in x if 100 < v < 201]
    assert abs(sum(v <= 100 for v in x) / N - 0.5) < 0.02


def test_half_bell(spark):
    x = list(column(spark, lambda d: d.half_bell("h", 0, 30)).values())
    assert min(x) == 0 and max(x) <= 30 and sum(v <= 5 for v in x) > 0.6 * N


def test_power_has_its_mass_at_the_low_end(spark):
    x = list(column(spark, lambda d: d.power("p", 1, 25, 15)).values())
    assert min(x) == 1 and max(x) <= 25
    counts = [x.count(v) for v in (1, 2, 3, 4)]
    assert counts == sorted(counts, reverse=True) and 0.4 < counts[0] / N < 0.55


def test_whole_and_flag(spark):
    x = list(column(spark, lambda d: d.whole("w", 1, 6)).values())
    assert all(abs(x.count(v) / N - 1 / 6) < 0.02 for v in range(1, 7)) and set(x) == set(range(1, 7))
    y = list(column(spark, lambda d: d.flag("f", 0.25)).values())
    assert abs(sum(y) / N - 0.25) < 0.02


def test_overflowing_digits_print_signs(spark):
    row = spark.range(1).select(retail_star.digits(F.lit(42), 5).alias("a"), retail_star.digits(F.lit(123456), 5).alias("b")).first()
    assert (row.a, row.b) == ("00042", "#####")


def test_orders_follow_weights_and_are_repeatable(spark):
    cfg = retail_star.RetailConfig(order_rows=4000, first_day="2010-01-01")
    people = spark.range(1, 301).withColumnRenamed("id", "customer_id")

    def orders(p):
        daily = retail_star.daily_customers(retail_star.lifetimes(p, cfg), retail_star.day_factors(spark, cfg), cfg)
        return retail_star.order_base(daily, cfg)

    one, other = orders(people.repartition(1)), orders(people.repartition(6))
    keep = ("order_id", "customer_id", "order_ts", "order_num", "ordering_session_id", "item_count")
    rows = sorted(tuple(r) for r in one.select(*keep).collect())
    assert rows == sorted(tuple(r) for r in other.select(*keep).collect())
    assert abs(len(rows) - 4000) < 400
    assert [r[0] for r in rows] == list(range(10_000_000, 10_000_000 + len(rows)))
    items = retail_star.order_items(spark.createDataFrame(one.collect(), one.schema), 1000, cfg)
    assert items.count() == sum(r[5] for r in rows)
    assert items.select("order_item_id").distinct().count() == items.count()


def test_active_counts_equal_explosion(spark):
    cfg = retail_star.RetailConfig(order_rows=10, first_day="2010-06-01")
    lives = retail_star.lifetimes(spark.range(1, 200).withColumnRenamed("id", "customer_id"), cfg)
    days = retail_star.day_factors(spark, cfg)
    got = {r.calendar_day: r.active for r in retail_star.active_counts(lives, days).filter("calendar_day <= date '2010-12-31'").collect()}
    want = {r.d: r.n for r in lives.select(F.explode(F.sequence("start_date", "last_date")).alias("d")).groupBy("d").agg(F.count("*").alias("n")).collect()}
    assert {d: n for d, n in got.items() if n} == want
