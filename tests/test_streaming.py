"""Streams: late rows, exactly-once batches, equality with the batch result."""

import datetime as dt

from tidemark.sources.shared import new_folder
from tidemark.streaming import loads, windows

T0 = dt.datetime(2024, 1, 1)
SCHEMA = "ts timestamp, host string, value double"


def put(spark, folder, minutes, value=1.0):
    rows = [(T0 + dt.timedelta(minutes=m), "h", value) for m in minutes]
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(folder)


def test_late_rows_are_dropped_and_state_survives_restarts(spark):
    source, target, checkpoint = (new_folder(spark, n) for n in ("in", "out", "cp"))

    def run():
        windows.to_files(windows.telemetry_windows(loads.file_stream(spark, source, SCHEMA), "ts", "host", "value"), target, checkpoint)

    put(spark, source, [0, 1, 2, 30])
    run()
    put(spark, source, [21, 4, 60])  # minute 4 is later than the watermark at 20 allows
    run()
    put(spark, source, [100])
    run()
    got = {(r.window_start - T0).seconds // 60: r.samples for r in spark.read.parquet(target).collect()}
    assert got == {0: 3, 20: 1, 30: 1, 60: 1}


def test_sliding_windows_count_twice(spark):
    source, target = new_folder(spark, "in"), new_folder(spark, "out")
    put(spark, source, [31, 500])
    windows.to_files(windows.telemetry_windows(loads.file_stream(spark, source, SCHEMA), "ts", "host", "value", "1 hour", "30 minutes"), target, new_folder(spark, "cp"))
    assert sorted((r.window_start - T0).seconds // 60 for r in spark.read.parquet(target).collect()) == [0, 30]


def test_a_restart_adds_nothing_and_another_stream_adds_its_rows(spark):
    source, target = new_folder(spark, "in"), new_folder(spark, "out")
    for m in (1, 2, 3):
        put(spark, source, [m])
    stream = loads.file_stream(spark, source, SCHEMA, files_per_batch=1)
    first = new_folder(spark, "cp")
    for _ in range(2):
        loads.append_batches(stream, target, first)
        got = [(r.rows, r.running) for r in loads.running_counts(spark, target).orderBy("batch").collect()]
        assert got == [(1, 1), (1, 2), (1, 3)]
    loads.append_batches(stream, target, new_folder(spark, "cp2"))  # another stream, whose batch ids start again
    assert spark.read.parquet(f"{target}/rows").count() == 6
    assert sorted(r.running for r in loads.running_counts(spark, target).collect()) == [1, 2, 3, 4, 5, 6]


def test_a_stream_over_its_limit_stops(spark):
    source, target = new_folder(spark, "in"), new_folder(spark, "out")
    spark.createDataFrame([("1|a",), ("x|b",)], "value string").coalesce(1).write.text(source)
    stream = loads.delimited_stream(spark, source, "id int, name string")
    try:
        loads.load_batches(stream, target, new_folder(spark, "cp"), limit_percent=10)
        raise AssertionError("the limit was not enforced")
    except Exception as e:  # noqa: BLE001 - the stream wraps the error
        assert "rejected" in str(e)
    loads.load_batches(stream, target, new_folder(spark, "cp3"), limit_percent=60)
    assert spark.read.parquet(f"{target}/rows").select("id").collect() == [(1,)]


def test_sessions_close_after_a_gap(spark):
    source, target = new_folder(spark, "in"), new_folder(spark, "out")
    put(spark, source, [0, 20, 50, 200, 210, 900])
    windows.to_files(windows.activity_spans(loads.file_stream(spark, source, SCHEMA), "ts", "host", "1 hour"), target, new_folder(spark, "cp"))
    got = sorted(((r.started - T0).seconds // 60, (r.last_seen - T0).seconds // 60, r.snapshots) for r in spark.read.parquet(target).collect())
    assert got == [(0, 50, 3), (200, 210, 2)]


def test_a_closed_input_leaves_no_window_open(spark):
    source, target = new_folder(spark, "in"), new_folder(spark, "out")
    put(spark, source, [0, 20, 500])
    windows.close_input(spark.read.schema(SCHEMA).parquet(source), "ts", source)
    windows.to_files(windows.telemetry_windows(loads.file_stream(spark, source, SCHEMA), "ts", "host", "value"), target, new_folder(spark, "cp"))
    assert sorted((r.window_start - T0).seconds // 60 for r in spark.read.parquet(target).collect()) == [0, 20, 500]
