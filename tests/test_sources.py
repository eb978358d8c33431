"""Loads with reject limits, layouts and what plans make of them, shared folders."""

import pytest
from pyspark.sql import functions as F

from tidemark.sources import layout, load
from tidemark.sources.shared import new_folder, shared_root
from tidemark.sources.tables import StoredTables

from conftest import DATA

SCHEMA = "id int, name string, price decimal(10,2), day date"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def text(spark, lines, files=1):
    path = new_folder(spark, "text")
    spark.createDataFrame([(x,) for x in lines], "value string").repartition(files).write.text(path)
    return path


def test_rejects_are_kept_with_their_text(spark):
    path = text(spark, ["1|a|1.50|2024-01-01", "x|b|2.00|2024-01-01", "3|c|3.00|not a day", "4|d||2024-01-02"])
    rows = load.read_delimited(spark, path, SCHEMA, load.PIPE_NULLS)
    assert sorted(r.id for r in load.accepted(rows).collect()) == [1, 4]
    assert sorted(r.line for r in load.rejected(rows).collect()) == ["3|c|3.00|not a day", "x|b|2.00|2024-01-01"]


def test_a_bad_field_counts_though_the_plan_does_not_need_it(spark):
    rows = load.read_delimited(spark, text(spark, ["1|a|oops|2024-01-01", "2|b|1.00|2024-01-01"]), SCHEMA)
    assert load.accepted(rows).select("id").collect() == [(2,)]
    assert load.accepted(rows).count() == 1


def test_row_limit_is_per_file(spark):
    bad = [f"x{i}|a|1|2024-01-01" for i in range(6)]
    rows = load.read_delimited(spark, text(spark, bad), SCHEMA)
    load.enforce_limit(rows, limit_rows=7)
    with pytest.raises(load.RejectLimitExceeded):
        load.enforce_limit(rows, limit_rows=6)


def test_percent_limit_stops_before_writing(spark):
    path = text(spark, ["x|a|1|2024-01-01"] + [f"{i}|a|1|2024-01-01" for i in range(3)])
    with pytest.raises(load.RejectLimitExceeded):
        load.load(spark, path, SCHEMA, "t_limit", limit_percent=20)
    assert not spark.catalog.tableExists("t_limit")
    load.load(spark, path, SCHEMA, "t_limit", limit_percent=25, error_table="t_limit_errors")
    load.load(spark, path, SCHEMA, "t_limit", limit_percent=100, error_table="t_limit_errors")
    assert (spark.table("t_limit").count(), spark.table("t_limit_errors").count()) == (6, 2)


def test_empty_input_loads(spark):
    load.load(spark, text(spark, []), SCHEMA, "t_empty", limit_rows=1, limit_percent=1)
    assert spark.table("t_empty").count() == 0


@pytest.mark.parametrize("orientation, codec", [("PARQUET", "QUICKLZ"), ("PARQUET", "GZIP"), ("COLUMN", "ZLIB"), ("COLUMN", "SNAPPY")])
def test_formats_round_trip(spark, orientation, codec):
    rows = StoredTables(spark, DATA)["part"]
    path = new_folder(spark, "part")
    layout.write_files(rows, path, layout.Layout(orientation=orientation, codec=codec))
    assert spark.read.format(layout.FORMATS[orientation]).load(path).exceptAll(rows).isEmpty()


def test_bucketed_join_has_no_exchange(spark):
    t = StoredTables(spark, DATA)
    layout.write_table(t["lineitem"], "b_lineitem", layout.Layout(buckets=4, bucket_by=("l_orderkey",)))
    layout.write_table(t["orders"], "b_orders", layout.Layout(buckets=4, bucket_by=("o_orderkey",)))
    both = spark.table("b_lineitem").hint("merge").join(spark.table("b_orders"), F.expr("l_orderkey = o_orderkey"))
    assert "Exchange" not in plan(both)
    assert both.count() == t["lineitem"].count()


def test_month_partitions_are_pruned(spark):
    rows = StoredTables(spark, DATA)["orders"].withColumn("order_month", layout.month_of("o_orderdate"))
    layout.write_table(rows, "m_orders", layout.Layout(partition_by=("order_month",)))
    hit = spark.table("m_orders").filter(layout.within_months("order_month", "1998-03-15", "1998-05-10"))
    text = plan(hit)
    assert "PartitionFilters: [isnotnull(order_month" in text and "199803" in text and "199805" in text
    assert hit.select("order_month").distinct().count() == 3


def test_slices_cover_and_clamp(spark):
    days = spark.sql("select explode(sequence(date '1991-12-01', date '1999-02-01')) d").withColumn("s", layout.slice_of("d", 7))
    got = {r.s: r.n for r in days.filter("d between date '1992-01-01' and date '1998-12-31'").groupBy("s").agg(F.count("*").alias("n")).collect()}
    assert sorted(got) == list(range(7)) and max(got.values()) - min(got.values()) <= 1
    assert days.agg(F.min("s"), F.max("s")).first()[:] == (0, 6)


def test_history_move_loses_and_doubles_nothing(spark):
    """Equal rows moved twice are kept twice; a rerun of a batch adds none; other runs stay."""
    rows = spark.range(10).withColumn("run_id", (F.col("id") % 2).cast("int"))
    how = layout.Layout(partition_by=("run_id",))
    layout.write_table(rows, "h_now", how)
    layout.move_to_history(spark, "h_now", "h_then", "run_id", 1, 1, "a")
    assert (spark.table("h_now").count(), spark.table("h_then").count()) == (5, 5)
    layout.write_table(rows.filter("run_id = 1"), "h_now", how, mode="append")
    layout.move_to_history(spark, "h_now", "h_then", "run_id", 1, 1, "b")
    assert (spark.table("h_now").count(), spark.table("h_then").count()) == (5, 10)
    layout.write_table(rows.filter("run_id = 1"), "h_now", how, mode="append")  # as after a failure before the source was emptied
    layout.move_to_history(spark, "h_now", "h_then", "run_id", 1, 1, "b")
    assert (spark.table("h_now").count(), spark.table("h_then").count()) == (5, 10)
    layout.move_to_history(spark, "h_now", "h_then", "run_id", 5, 9, "c")
    assert spark.table("h_then").count() == 10


def test_history_of_a_table_with_a_path(spark):
    rows = spark.range(8).withColumn("run_id", F.lit(3))
    layout.write_table(rows, "h_out", layout.Layout(partition_by=("run_id",)), path=new_folder(spark, "h_out"))
    layout.move_to_history(spark, "h_out", "h_out_then", "run_id", 3, 3, "a")
    assert (spark.table("h_out").count(), spark.table("h_out_then").count()) == (0, 8)


def test_append_keeps_the_layout(spark):
    rows = spark.range(2000).withColumn("k", F.col("id") % 3)
    for name, how in (("a_parts", layout.Layout(partition_by=("k",))), ("a_buckets", layout.Layout(bucket_by=("id",), buckets=4))):
        layout.write_table(rows, name, how)
        first = len(spark.table(name).inputFiles())
        layout.write_table(rows.repartition(40), name, mode="append")
        assert len(spark.table(name).inputFiles()) <= 2 * first and spark.table(name).count() == 4000


def test_shared_folder_comes_from_the_session(spark):
    assert shared_root(spark) == spark.conf.get("spark.checkpoint.dir").rstrip("/")
    assert new_folder(spark, "a") != new_folder(spark, "a")


def test_filters_and_columns_reach_the_scan(spark, capsys):
    from tidemark.plans import tpch
    from tidemark.sources.tables import tpch_tables

    tpch.q06(tpch_tables(spark, DATA)).explain("formatted")
    text = capsys.readouterr().out
    assert "GreaterThanOrEqual(l_shipdate,1997-01-01" in text and "LessThan(l_quantity,24.0)" in text
    assert "ReadSchema: struct<l_quantity:double,l_extendedprice:double,l_discount:double,l_shipdate:timestamp_ntz>" in text


def test_a_day_of_orders_prunes_the_scan(spark, capsys):
    from tidemark.plans import retail
    from tidemark.sources.tables import retail_tables

    retail.r001(retail_tables(spark, DATA)).explain("formatted")
    text = capsys.readouterr().out
    assert "GreaterThanOrEqual(l_shipdate,1998-01-05" in text and "LessThanOrEqual(l_shipdate,1998-01-06" in text


def test_colocated_tables_join_where_they_lie(spark, capsys):
    """By name, whatever their size: neither input is exchanged."""
    from tidemark.plans import micro
    from tidemark.sources.tables import colocated_tables, tpch_tables

    t = colocated_tables(spark, DATA)
    got, want = micro.x09(t), micro.x09(tpch_tables(spark, DATA))
    assert got.collect() == want.collect()
    merged = micro.x09({n: t[n].hint("merge") for n in ("lineitem", "orders")})
    text = plan(merged)
    assert text.count("Exchange") == 1 and "SinglePartition" in text  # one row per task at the end
    assert t["lineitem"].rdd.getNumPartitions() == t["orders"].rdd.getNumPartitions() == 8
    assert t["part"].count() == StoredTables(spark, DATA)["part"].count()


def test_parts_follow_from_bytes(spark):
    rows = StoredTables(spark, DATA)["lineitem"]
    size = layout.stored_bytes(rows)
    assert layout.parts_for(rows) == 8  # the cores
    assert layout.parts_for(rows, part_bytes=size // 100) in (64, 128)
    assert layout.parts_for(rows, StoredTables(spark, DATA)["region"], part_bytes=size // 100) == layout.parts_for(rows, part_bytes=size // 100)
    assert layout.parts_for(rows, part_bytes=1) <= layout.MOST_PARTS


def test_histograms_change_the_join_order(spark):
    """Most rows of a dimension lie at the low end of its range. Without a histogram the
    optimizer takes the filter on it for a selective one."""
    n = 4000
    fact = spark.range(5 * n).select((F.col("id") % n).alias("k1"), (F.col("id") * 7 % n).alias("k2"), F.col("id").alias("m"))
    skewed = spark.range(n).select(F.col("id").alias("d1"), F.when(F.col("id") % 100 == 0, F.col("id") % 1000).otherwise(F.col("id") % 10).alias("a"))
    even = spark.range(n).select(F.col("id").alias("d2"), (F.col("id") % 1000).alias("b"))
    for name, rows in (("hist_fact", fact), ("hist_skewed", skewed), ("hist_even", even)):
        layout.write_table(rows, name)
    joined = "select count(*) from hist_fact, hist_skewed, hist_even where k1 = d1 and k2 = d2 and a < 100 and b < 300"

    def first_joined(bins):
        for name in ("hist_fact", "hist_skewed", "hist_even"):
            layout.analyze(spark, name, bins=bins)
        lines = spark.sql(joined)._jdf.queryExecution().optimizedPlan().toString().split("\n")
        conditions = [x for x in lines if "Join Inner" in x]
        assert len(conditions) == 2
        return "d1" if "d1" in conditions[-1] else "d2"  # the inner one comes last

    assert (first_joined(0), first_joined(50)) == ("d1", "d2")
    assert spark.sql(joined).first()[0] == 5 * sum(1 for i in range(n) if (i % 1000 if i % 100 == 0 else i % 10) < 100 and i * 7 % n % 1000 < 300)
