"""Spans by the difference of snapshots, against the batch report."""

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.plans import telemetry
from tidemark.sources.shared import new_folder
from tidemark.streaming import loads, windows
from tidemark.streaming.snapshots import _distinct, _ended, _steps, spans_of_snapshots

T0 = dt.datetime(2024, 1, 1)
SCHEMA = "monitor string, at timestamp, sess_id long, query_no long, user_name string"


def put(spark, folder, rows):
    spark.createDataFrame([(m, T0 + dt.timedelta(minutes=t), s, q, u) for m, t, s, q, u in rows], SCHEMA).coalesce(1).write.mode("append").parquet(folder)


def run(spark, source, target, checkpoint, files=1):
    stream = loads.file_stream(spark, source, SCHEMA, files_per_batch=files)
    windows.to_files(spans_of_snapshots(stream, "at", "monitor"), target, checkpoint)


def found(spark, target):
    rows = spark.read.parquet(target).collect()
    minutes = lambda t: int((t - T0).total_seconds() // 60)
    return sorted([(r.monitor, r.sess_id, r.query_no, r.user_name, minutes(r.query_start_time), minutes(r.query_end_time), r.snapshots) for r in rows], key=str)


def test_a_query_ends_with_the_first_snapshot_that_lacks_it(spark):
    """Snapshots out of order and in several runs; another monitor's do not count."""
    source, target, checkpoint = (new_folder(spark, n) for n in ("in", "out", "cp"))
    a, b = ("m1", 1, 1, "x"), ("m1", 2, 1, None)
    at = lambda who, t: (who[0], t, *who[1:])
    put(spark, source, [at(a, 0), at(b, 0), at(b, 5)])
    put(spark, source, [at(a, 3), at(a, 3), at(b, 3)])  # late, and one row twice
    run(spark, source, target, checkpoint)
    put(spark, source, [at(b, 9), at(a, 40), at(b, 40), ("m2", 41, 7, 1, "z")])  # a comes again
    run(spark, source, target, checkpoint)
    put(spark, source, [("m1", 45, None, None, None), ("m2", 60, 7, 1, "z"), ("m2", 61, 8, 1, "z"), ("m1", 100, 3, 1, "x"), ("m2", 200, 9, 1, "z"), ("m1", 200, 3, 1, "x")])
    run(spark, source, target, checkpoint)
    put(spark, source, [("m2", 300, 9, 1, "z")])
    run(spark, source, target, checkpoint)
    assert found(spark, target) == [("m1", 1, 1, "x", 0, 5, 2), ("m1", 1, 1, "x", 40, 45, 1), ("m1", 2, 1, None, 0, 45, 5), ("m2", 7, 1, "z", 41, 61, 2), ("m2", 8, 1, "z", 61, 200, 1)]


@pytest.mark.parametrize("files", [1, 4])
def test_a_stream_gives_the_spans_of_the_batch(spark, files):
    """Snapshots every five minutes of sessions that come and go."""
    source, target = new_folder(spark, "in"), new_folder(spark, "out")
    rows = spark.range(0, 300).select(F.explode(F.sequence(F.lit(0), F.lit(40))).alias("t"), "id").filter(F.pmod(F.xxhash64("id", F.floor(F.col("t") / 6)), F.lit(7)) == 0)
    activity = rows.select(F.lit("m").alias("monitor"), (F.lit(T0).cast("timestamp") + F.make_dt_interval(mins=F.col("t") * 5)).alias("at"),
                           F.col("id").alias("sess_id"), F.lit(1).cast("long").alias("query_no"), F.lit("u").alias("user_name")).cache()
    for i in range(4):  # a file after another, as they come
        activity.filter(F.floor(F.minute("at") / 60 + F.hour("at")) == i).coalesce(1).write.mode("append").parquet(source)
    windows.close_input(activity, "at", source)
    run(spark, source, target, new_folder(spark, "cp"), files)
    got = spark.read.parquet(target)
    whole = telemetry.spans_from_activity(activity.withColumnRenamed("at", "snapshot"))
    # the batch report takes a session's gaps for parts of one span
    last = got.groupBy("sess_id").agg(F.min("query_start_time").alias("s"), F.max("query_end_time").alias("e"), F.sum("snapshots").alias("n"))
    still = activity.agg(F.max("at")).first()[0]
    ran = {r.sess_id for r in activity.filter(F.col("at") == F.lit(still)).select("sess_id").collect()}
    want = {r.sess_id: (r.query_start_time, r.query_end_time, r.snapshots) for r in whole.collect()}
    have = {r.sess_id: (r.s, r.e, r.n) for r in last.collect() if r.sess_id not in ran}
    assert have == want and len(want) > 100


def test_rows_that_wait_are_stored_as_numbers(spark):
    """Sixty thousand rows in one batch, before the watermark moves: bytes of the state."""
    source, target, checkpoint = (new_folder(spark, n) for n in ("in", "out", "cp"))
    rows = spark.range(60_000).select(F.lit("m").alias("monitor"), (F.lit(T0).cast("timestamp") + F.make_dt_interval(mins=(F.col("id") / 200).cast("int"))).alias("at"),
                                      (F.col("id") % 200).alias("sess_id"), F.lit(1).cast("long").alias("query_no"), F.lit("somebody").alias("user_name"))
    rows.coalesce(1).write.parquet(source)
    run(spark, source, target, checkpoint)
    held = spark.read.format("statestore").load(checkpoint).agg(F.sum(F.length(F.to_json("value")))).first()[0]
    assert 0 < held < 8 * 60_000
    windows.close_input(rows, "at", source)
    run(spark, source, target, checkpoint)
    assert found(spark, target) == []  # what runs in the last snapshot goes on


def test_snapshots_are_compared_some_at_a_time():
    rng = np.random.default_rng(3)
    rows = _distinct([(rng.integers(0, 40, 500), rng.integers(0, 20, 500))])
    whole, left = _ended(np.empty((4, 0), np.int64), rows)
    for most in (1, 7, 100, 10_000):
        parts, running = [], np.empty((4, 0), np.int64)
        for some in _steps(*rows, most):
            done, running = _ended(running, some)
            parts += done.T.tolist()
        assert sorted(parts) == sorted(whole.T.tolist()) and sorted(running.T.tolist()) == sorted(left.T.tolist())
