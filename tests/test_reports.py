"""Run comparison and telemetry on literal rows with known outcomes."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemark.plans import retail, runs, telemetry

T0 = dt.datetime(2024, 1, 1)


@pytest.mark.parametrize("actual, base, status, base_status, want", [
    (100.0, 100.0, "PASS", None, runs.NEW),
    (90.0, 100.0, "PASS", "PASS", runs.PASS), (110.0, 100.0, "PASS", "PASS", runs.PASS),
    (89.0, 100.0, "PASS", "PASS", runs.BETTER), (111.0, 100.0, "PASS", "PASS", runs.WORSE),
    (29.0, 99.0, "PASS", "PASS", runs.BETTER), (31.0, 99.0, "PASS", "PASS", runs.PASS), (298.0, 99.0, "PASS", "PASS", runs.WORSE),
    (0.0, 100.0, "ERROR", "PASS", "ERROR"), (0.0, 100.0, "SKIP", "PASS", "SKIP"), (50.0, 0.0, "PASS", "PASS", "PASS"), (50.0, 60.0, "PASS", "SKIP", "PASS"),
])
def test_classes(spark, actual, base, status, base_status, want):
    row = spark.createDataFrame([(actual, base, status, base_status)], "a double, b double, s string, t string")
    assert row.select(runs.classify("a", "b", "s", "t")).first()[0] == want


def tables(spark, results, baseline=()):
    work = [(1, "SOLO", 1, False), (2, "MANY", 4, True)]
    return {
        "workload": spark.createDataFrame(work, "wl_id int, wl_name string, wl_concurrency int, wl_disrandomly boolean"),
        "scenario": spark.createDataFrame([(10, 1), (20, 2)], "s_id int, wl_id int"),
        "test_result": spark.createDataFrame(results, "tr_id int, s_id int, adj_s_id int, action_type string, action_target string, stream int, status string, duration bigint"),
        "test_baseline": spark.createDataFrame(list(baseline), "storage_version string, engine_version string, s_id int, adj_s_id int, action_type string, action_target string, stream int, status string, duration bigint"),
    }


def test_one_error_marks_the_action_and_zeroes_its_time(spark):
    t = tables(spark, [(1, 10, 20, "Execution", "q1", 0, "SUCCESS", 100), (1, 10, 20, "Execution", "q1", 0, "ERROR", 300),
                       (1, 10, 20, "Execution", "q2", 0, "SUCCESS", 100), (1, 10, 20, "Execution", "q2", 0, "SUCCESS", 201)])
    got = {r.action_target: (r.status, float(r.duration)) for r in runs.results(t, 1).collect()}
    assert got == {"q1": ("ERROR", 0.0), "q2": ("PASS", 150.5)}


def test_concurrent_is_mean_of_stream_sums(spark):
    rows = [(1, 20, 10, "Execution", q, s, "SUCCESS", d) for q, s, d in (("a", 0, 10), ("a", 0, 30), ("b", 0, 5), ("a", 1, 40), ("b", 1, 15))]
    got = runs.results(tables(spark, rows), 1).collect()
    # Stream 0: mean(10, 30) + 5 = 25; stream 1: 55; mean 40.
    assert [(r.action_target, float(r.duration)) for r in got] == [("CONCURRENT_QUERY", 40.0)]


def test_report_with_twin_and_summary(spark):
    t = tables(spark, [(1, 10, 20, "Execution", "q1", 0, "SUCCESS", 300), (1, 20, 10, "Execution", "q1", 0, "SUCCESS", 150)],
               [("S", "E", 10, 20, "Execution", "q1", 0, "SUCCESS", 200), ("S", "E", 20, 10, "Execution", "q1", 0, "SUCCESS", 150)])
    report = runs.run_vs_version(t, 1, "S", "E")
    got = {(r.wl_name, r.test_result) for r in report.collect()}
    assert got == {("SOLO", runs.WORSE), ("MANY_CONCURRENT", runs.PASS), ("MANY_CONCURRENT_RWITHD", runs.NEW)}
    final = {r.wl_name: (r.test_result_all, r.failurenum) for r in runs.summary(report).collect()}
    assert final == {"SOLO": ("FAILURE", 1), "MANY_CONCURRENT": ("PASS", 0), "MANY_CONCURRENT_RWITHD": ("SKIP", 0)}
    lines = [r.line for r in runs.report_lines(report).collect()]
    assert len(lines) == 2 and any("Comparison is: 1.50 (300 ms)|Test Status|FAILURE" in x for x in lines)


def test_process_lines(spark):
    head = "1034 1.0 656480 16676 0.4 S server: port 40001, user db 127.0.0.1(51217) con64 "
    lines = [head + "seg1 idle", head + "seg0 cmd6 MPPEXEC INSERT", head + "seg2 cmd2 slice1 MPPEXEC SELECT", head.replace("16676", "none") + "seg1 idle",
             head + "writer process", head + "seg1 cmd6 MPPEXEC"]
    got = telemetry.parse_process_lines(spark.createDataFrame([(x,) for x in lines], "line string")).collect()
    assert sorted((r.con_id, r.seg_id, r.cmd or "", r.slice or "", r.status, r.rss) for r in got) == [
        ("64", "seg0", "cmd6", "", "INSERT", 16), ("64", "seg1", "", "", "idle", 16), ("64", "seg2", "cmd2", "slice1", "SELECT", 16)]


@pytest.mark.parametrize("growth, angle, alarm", [(0.0, 0, False), (0.2, 11, False), (1.0, 45, True), (-1.0, -45, True)])
def test_leak_angle(spark, growth, angle, alarm):
    rows = [(h, s, 1e9, 0.0, 1e9 - 1024 * 1024 * (100 + growth * s)) for h in ("a", "b") for s in range(50)]
    r = telemetry.leak_angle(spark.createDataFrame(rows, "host string, slot bigint, mem_total double, mem_cached double, mem_free double")).first()
    assert abs(r.angle - angle) <= 1 and r.alarm == alarm


def test_leak_angle_needs_two_samples(spark):
    r = telemetry.leak_angle(spark.createDataFrame([("a", 1, 10.0, 0.0, 5.0)], "host string, slot bigint, mem_total double, mem_cached double, mem_free double")).first()
    assert (r.angle, r.alarm) == (-90, True)


def test_queries_without_samples_stay(spark):
    end = T0 + dt.timedelta(minutes=5)
    spans = spark.createDataFrame([(1, "SUCCESS", "W", "Execution", "q", 0, 1, T0, end), (1, "ERROR", "W", "Loading", "t", 0, 2, T0, end), (1, "SKIP", "W", "Execution", "s", 0, 1, T0, end),
                                   (2, "SUCCESS", "W", "Execution", "other run", 0, 1, T0, end)],
                                  "run_id int, status string, wl_name string, action_type string, action_target string, stream int, con_id bigint, start_time timestamp_ntz, end_time timestamp_ntz")
    samples = [(1, "h", i, T0 + dt.timedelta(minutes=i), 1, f"seg{i % 2}", i * 1.0, 2.0, 0.0) for i in range(6)]
    seg = telemetry.per_segment(spark.createDataFrame(samples, "run_id int, hostname string, timeslot bigint, real_time timestamp_ntz, con_id bigint, seg_id string, rss double, pmem double, pcpu double").withColumns(
        {c: F.col(c).cast("decimal(8,2)") for c in ("rss", "pmem", "pcpu")}))
    got = {r.query_name: r for r in telemetry.segment_statistics(spans, seg).collect()}
    q = got["q"]  # the sample at the span's end is outside
    assert (q.segnum, float(q.rss_max), float(q.rss_min), float(q.rss_ratio), float(q.pcpu_ratio)) == (2, 4.0, 3.0, 1.33, 0.0)
    assert got["Loading_t"].segnum == 0 and got["Loading_t"].rss_max is None
    assert got["other run"].segnum == 0 and "s" not in got


def test_first_and_last_orders_of_a_hot_customer(spark):
    # The default frame ends at the first instant's peers, the whole frame at the end.
    rows = [(1, 5, "C", T0 + dt.timedelta(hours=h), f"O{n}") for n, h in enumerate((0, 0, 1, 2))] + [(2, 5, "C", T0, "O9")]
    lines = spark.createDataFrame(rows, "customer_id bigint, product_category_id bigint, product_category_name string, order_datetime timestamp_ntz, order_id string")
    got = {r.customer_id: (r.first_order_id, r.last_order_id) for r in retail.first_last(lines).collect()}
    assert got == {1: ("O0", "O1"), 2: ("O9", "O9")}
    whole = {r.customer_id: (r.first_order_id, r.last_order_id) for r in retail.first_last(lines, whole_frame=True).collect()}
    assert whole == {1: ("O0", "O3"), 2: ("O9", "O9")}


def test_between_with_a_date_takes_midnight_only(spark):
    rows = [("a", T0, 1), ("b", T0 + dt.timedelta(days=1), 2), ("c", T0 + dt.timedelta(days=1, seconds=1), 3)]
    t = {"order_lineitems": spark.createDataFrame([(o, d, q, 1) for o, d, q in rows], "order_id string, order_datetime timestamp_ntz, item_quantity int, customer_id bigint")}
    assert retail.r001(t, "2024-01-01", "2024-01-02").first().num_items == 3
