"""Orders wanted on days that most customers order on."""

import pytest
from pyspark.sql import functions as F

from tidemark.plans import retail_star

CUSTOMERS = 60


@pytest.mark.parametrize("rows", [3000, 12000, 20000])
def test_no_order_is_lost_where_chances_are_large(spark, rows):
    cfg = retail_star.RetailConfig(order_rows=rows, first_day="2010-01-01")
    lives = retail_star.lifetimes(spark.range(1, CUSTOMERS + 1).withColumnRenamed("id", "customer_id"), cfg)
    lives = lives.withColumn("start_date", F.lit(cfg.first_day).cast("date")).withColumn("last_date", F.lit(cfg.last_day).cast("date"))
    factors = retail_star.day_factors(spark, cfg)
    whole = factors.agg(F.sum("factor")).first()[0]
    # a customer orders once a day at most
    wanted = sum(min(rows * r.factor / whole, CUSTOMERS) for r in factors.collect())
    daily = retail_star.daily_customers(lives, factors, cfg)
    per = {r.customer_id: r["count"] for r in daily.groupBy("customer_id").count().collect()}
    assert len(per) == CUSTOMERS and all(abs(n - wanted / CUSTOMERS) <= 1 + 1e-6 for n in per.values())
    assert daily.distinct().count() == daily.count() == sum(per.values())
    assert abs(sum(per.values()) - wanted) < 4 * CUSTOMERS ** 0.5
