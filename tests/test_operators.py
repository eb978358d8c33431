"""Operators against brute force on small frames, also where one key is hot."""

import datetime as dt

import pytest
from pyspark.sql import Window as W, functions as F

from tidemark.operators import validate
from tidemark.operators.interval_join import interval_join
from tidemark.operators.keys import dense_ids, gapped_ids
from tidemark.operators.ranks import spread_rank
from tidemark.plans.tpch import not_in

T0 = dt.datetime(2024, 1, 1)


def at(minutes):
    return T0 + dt.timedelta(minutes=minutes)


def test_dense_ids_do_not_depend_on_partitions(spark):
    rows = spark.range(500).select((F.col("id") * 7919 % 500).alias("k"))
    one = {(r.k, r.n) for r in dense_ids(rows.repartition(1), "n", ["k"], start=10).collect()}
    many = {(r.k, r.n) for r in dense_ids(rows.repartition(9), "n", ["k"], start=10).collect()}
    assert one == many == {(i, i + 10) for i in range(500)}


def test_gapped_ids_are_unique(spark):
    ids = [r.n for r in gapped_ids(spark.range(100).repartition(5), "n").collect()]
    assert len(set(ids)) == 100 and min(ids) >= 1


@pytest.mark.parametrize("closed", [False, True])
def test_interval_join_equals_brute_force(spark, closed):
    # Key 0 holds a third of the points; spans touch, nest, and end before they start.
    points = [(0 if i % 3 == 0 else i % 5, at(i * 7)) for i in range(300)]
    spans = [(k, n, at(n * 50), at(n * 50 + length)) for k in range(5) for n, length in enumerate((0, 35, 700, -20, 50, 2000))]
    got = interval_join(
        spark.createDataFrame(points, "k int, at timestamp_ntz"), spark.createDataFrame(spans, "k int, n int, lo timestamp_ntz, hi timestamp_ntz"),
        ["k"], "at", "lo", "hi", bin_seconds=3600, closed=closed)
    inside = (lambda a, lo, hi: lo <= a <= hi) if closed else (lambda a, lo, hi: lo <= a < hi)
    want = sorted((k, a, n) for k, a in points for j, n, lo, hi in spans if j == k and inside(a, lo, hi))
    assert sorted((r.k, r["at"], r.n) for r in got.collect()) == want


def test_interval_join_without_keys(spark):
    points = spark.createDataFrame([(at(i),) for i in range(0, 300, 10)], "at timestamp_ntz")
    spans = spark.createDataFrame([(1, at(5), at(95)), (2, at(90), at(250))], "n int, lo timestamp_ntz, hi timestamp_ntz")
    got = interval_join(points, spans, [], "at", "lo", "hi", 1800).groupBy("n").count().collect()
    assert {r["n"]: r["count"] for r in got} == {1: 9, 2: 16}


def test_spread_rank_equals_rank(spark):
    rows = spark.range(400).select(F.expr("if(id % 3 = 0, 'hot', concat('g', id % 4))").alias("g"), F.expr("cast((id * 37) % 23 as double) * 0.5").alias("v"))
    rows = rows.unionByName(spark.createDataFrame([("single", 4.0)], "g string, v double"))
    want = rows.withColumn("r", F.rank().over(W.partitionBy("g").orderBy("v")))
    got = spread_rank(rows, "v", "r", ["g"], buckets=4)
    key = lambda df: sorted((x.g, x.v, x.r) for x in df.collect())
    assert key(got) == key(want)


def test_spread_rank_keeps_nulls_and_spreads_outliers(spark):
    rows = spark.createDataFrame([("a", 2.0), ("a", None), (None, 1.0), (None, None), ("a", 1.0), ("a", None)], "g string, v double")
    got = sorted(((r.g, r.v, r.r) for r in spread_rank(rows, "v", "r", ["g"]).collect()), key=str)
    assert got == sorted([("a", 1.0, 1), ("a", 2.0, 2), ("a", None, 3), ("a", None, 3), (None, 1.0, 1), (None, None, 2)], key=str)
    many = spark.range(20000).select(F.lit("a").alias("g"), F.when(F.col("id") == 0, 1e12).otherwise(F.col("id").cast("double")).alias("v"))
    assert spread_rank(many, "v", "r", ["g"]).filter("r = if(v = 1e12, 20000, v)").count() == 20000


def test_difference_counts_copies(spark):
    a = spark.createDataFrame([(1, "x"), (1, "x"), (2, None), (3, "z")], "k int, v string")
    b = spark.createDataFrame([(1, "x"), (2, None), (4, "z"), (4, "z")], "k int, v string")
    got = {(r.k, r.side): r.copies for r in validate.difference(a, b).collect()}
    assert got == {(1, "+"): 1, (3, "+"): 1, (4, "-"): 2}
    assert validate.difference(a, a).isEmpty()


def test_difference_ignores_volatile_columns(spark):
    a = spark.createDataFrame([(1, "now")], "k int, t string")
    b = spark.createDataFrame([(1, "then")], "k int, t string")
    assert validate.difference(a, b, ignore=("t",)).isEmpty()
    with pytest.raises(ValueError):
        validate.difference(a, b.drop("t"))


def test_digest_is_independent_of_order(spark):
    rows = spark.range(1000).select("id", F.expr("if(id % 7 = 0, null, id * 3)").alias("v"))
    assert validate.digest(rows).first() == validate.digest(rows.orderBy(F.desc("id")).repartition(7)).first()
    assert validate.digest(rows).first() != validate.digest(rows.filter("id <> 5")).first()


def test_check_prefers_the_answer(spark):
    rows = spark.range(5)
    d = validate.digest(rows).first()
    good = (d["row_count"], d["hash_sum"])
    assert validate.check(rows, answer=rows).status == "PASS"
    assert validate.check(rows, answer=rows.limit(3), expected_digest=good).status == "FAIL"
    assert validate.check(rows, expected_digest=good).how == "digest"
    assert validate.check(rows, expected_digest=(5, "0")).status == "FAIL"
    assert validate.check(rows).status == "ERROR"


def test_row_counts(spark):
    got = {r.table_name: r.passed for r in validate.row_counts({"a": spark.range(5), "b": spark.range(0)}, {"a": 5}).collect()}
    assert got == {"a": True, "b": False}


@pytest.mark.parametrize("others", [[], [None], [1, 2], [1, None], [7]])
def test_not_in_with_nulls(spark, others):
    import duckdb

    left = spark.createDataFrame([(1,), (2,), (3,), (3,), (None,)], "k int")
    right = spark.createDataFrame([(x,) for x in others], "o int")
    values = ", ".join(f"({'null' if x is None else x})" for x in others) or "(0)"
    where = "" if others else " where false"
    want = duckdb.sql(f"select k from (values (1), (2), (3), (3), (null)) l(k) where k not in (select o::int from (values {values}) r(o){where}) order by k").fetchall()
    got = sorted(((r.k,) for r in not_in(left, right, "k", "o").collect()), key=lambda r: (r[0] is None, r[0] or 0))
    assert got == want
