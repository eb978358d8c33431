"""Reports over a range of runs hold the whole tables at every scale."""

import pytest
from pyspark.sql import functions as F

from tidemark.plans import telemetry
from tidemark.sources.tables import monitor_tables


@pytest.mark.parametrize("scale", ["sf0.001", "sf0.01"])
def test_monitor_report_over_all_runs(spark, scale):
    t = monitor_tables(spark, f"/root/testdata/{scale}")
    report = telemetry.monitor_report(t, 1, 2)
    # samples of a slot and connection are one, whatever the run
    whole = telemetry.per_node(telemetry.per_segment(t["worker_samples"]), telemetry.master_per_connection(t["master_samples"]))
    total = lambda nodes: nodes.groupBy("role").agg(F.sum("segnum").alias("n"), F.sum("rss").alias("rss")).orderBy("role").collect()
    assert total(report["nodes"]) == total(whole)
    sampled = t["worker_samples"].agg(F.sum("rss")).first()[0]
    assert {r.role: r.rss for r in total(report["nodes"])}["QE"] == sampled
    ran = t["run_spans"].filter("status <> 'SKIP'")
    assert report["segments"].count() == report["master"].count() == ran.count()
    assert report["windows"].select("run_id", "wl_name").distinct().count() == ran.select("run_id", "wl_name").distinct().count()
    one = telemetry.monitor_report(t, 1, 1)["nodes"]
    assert {r.run_id for r in one.select("run_id").distinct().collect()} == {1}
    assert 0 < one.count() < report["nodes"].count()


def test_windows_of_a_run_follow_each_other(spark):
    """The time that windows cover together grows with the run, not with its square."""
    t = monitor_tables(spark, "/root/testdata/sf0.01")
    rows = telemetry.result_windows(t["run_spans"]).collect()
    for run in (1, 2):
        mine = [r for r in rows if r.run_id == run]
        whole = (max(r.end_time for r in mine) - min(r.start_time for r in mine)).total_seconds()
        assert len({r.wl_name for r in mine}) == 24
        assert sum((r.end_time - r.start_time).total_seconds() for r in mine) < 4 * whole
