import re

from pyspark.sql import Window as W, functions as F

from tidemark.plans import retail_star


def _addresses(spark):
    people = spark.createDataFrame([(i, f"F{i}", f"L{i}", "M") for i in range(1, 301)], "customer_id long, first_name string, last_name string, gender string")
    zips = spark.createDataFrame([("00001", "City 1", "TN"), ("00002", "City 2", "GA")], "zip_code string, city string, state string")
    streets = spark.createDataFrame([("Street 1",), ("Street 2",)], "street_name string")
    return retail_star.addresses(people, zips, streets, retail_star.RetailConfig(order_rows=1000))


def test_a_version_ends_where_the_next_newer_begins(spark):
    rows = _addresses(spark)
    newer = W.partitionBy("customer_id").orderBy(F.desc("valid_from_timestamp"), F.desc("version"))
    wrong = rows.withColumn("want", F.lag("valid_from_timestamp").over(newer)).filter(~F.col("valid_to_timestamp").eqNullSafe(F.col("want")))
    assert wrong.count() == 0
    assert rows.filter("valid_to_timestamp is null").groupBy("customer_id").count().filter("count != 1").count() == 0
    assert rows.select("customer_id").distinct().count() == 300
    assert rows.groupBy("customer_id").count().filter("count > 1").count() > 0


def test_versions_are_not_shuffled_by_customer(spark):
    plan = _addresses(spark)._jdf.queryExecution().executedPlan().toString()
    assert not re.search(r"hashpartitioning\(customer_id", plan)
