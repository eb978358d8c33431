"""Promotions, archived reports and loads: repeated, stopped half way, started again."""

import pytest
from pyspark.sql import functions as F

from conftest import DATA
from tidemark.plans import baselines, monitor_archive, runs, telemetry
from tidemark.sources import layout, load
from tidemark.sources.shared import folder_exists, new_folder, subfolders
from tidemark.sources.tables import monitor_tables


class Stopped(Exception):
    pass


def fail(*_, **__):
    raise Stopped


def fresh(spark, name):
    path = new_folder(spark, name)
    return path.rsplit("/", 1)[1].replace("-", "_"), path


def same(a, b):
    return a.exceptAll(b.select(*a.columns)).isEmpty() and b.select(*a.columns).exceptAll(a).isEmpty()


@pytest.fixture(scope="module")
def monitor(spark):
    return monitor_tables(spark, DATA)


def test_promoting_twice_changes_nothing(spark, monitor, monkeypatch):
    first = monitor["test_baseline"]
    stored = baselines.StoredBaseline.create(first, *fresh(spark, "baseline"))
    assert same(stored.rows(), first)
    with monkeypatch.context() as m:  # the rows are there, but do not count yet
        m.setattr(baselines.StoredBaseline, "_set", fail)
        with pytest.raises(Stopped):
            stored.promote(monitor, (104, 105), "S3", "E3")
    assert same(stored.rows(), first) and stored.versions("S3", "E3") == 0
    assert stored.promote(monitor, (104, 105), "S3", "E3")
    want = first.unionByName(runs.promote(monitor, (104, 105), "S3", "E3"))
    assert same(stored.rows(), want)
    assert not stored.promote(monitor, (105, 104, 104), "S3", "E3") and same(stored.rows(), want)
    assert stored.versions("S3", "E3") == 1


def test_promotions_add_replace_and_go_back(spark, monitor):
    first = monitor["test_baseline"]
    stored = baselines.StoredBaseline.create(first, *fresh(spark, "baseline"))
    old = first.select("storage_version", "engine_version").first()
    others = first.filter(~((F.col("storage_version") == old[0]) & (F.col("engine_version") == old[1])))
    more = runs.promote(monitor, (106,), *old)
    assert stored.promote(monitor, (106,), *old) and same(stored.rows(), first.unionByName(more))
    assert stored.promote(monitor, (106,), *old, replace=True) and same(stored.rows(), others.unionByName(more))
    assert not stored.promote(monitor, (106,), *old, replace=True)
    assert same(stored.rows(version=1), first) and same(stored.rows(version=2), first.unionByName(more))
    stored.restore(*old, 1)
    assert same(stored.rows(), first) and stored.versions(*old) == 4


@pytest.mark.parametrize("stop", ["nodes", "move run_spans", "move worker_samples", monitor_archive.PUBLISHED])
def test_an_archived_report_goes_on_where_it_stopped(spark, monitor, monkeypatch, stop):
    store = monitor_archive.MonitorStore.create(monitor, fresh(spark, "monitor")[0])
    want = {n: f.withColumn("report", F.lit("r1")) for n, f in telemetry.monitor_report(monitor, 1, 1).items()}
    kept = monitor_archive.MonitorStore._note

    def note(self, report, steps):
        if steps[-1] == stop:  # the step is done, but not noted
            raise Stopped
        kept(self, report, steps)

    with monkeypatch.context() as m:
        m.setattr(monitor_archive.MonitorStore, "_note", note)
        with pytest.raises(Stopped):
            store.report(1, 1, "r1", clear=True)
    assert store.frame("windows").isEmpty()
    for _ in range(2):
        store.report(1, 1, "r1", clear=True)
    for n in monitor_archive.RAW:
        assert same(monitor[n].filter("run_id <> 1"), store.raw(n)) and same(monitor[n].filter("run_id = 1"), store.history(n).drop("batch_id"))
    for n in ("windows", "segments", "hosts"):
        assert same(want[n], store.frame(n))


def test_reports_stand_beside_each_other(spark, monitor):
    store = monitor_archive.MonitorStore.create(monitor, fresh(spark, "monitor")[0])
    store.report(1, 1, "one")
    store.report(1, 2, "both", clear=True)
    assert {r.report for r in store.frame("nodes").select("report").distinct().collect()} == {"one", "both"}
    assert store.raw("run_spans").isEmpty() and store.history("run_spans").count() == monitor["run_spans"].count()
    with pytest.raises(ValueError):
        store.report(1, 1, "no name'")


def test_a_move_that_stops_between_runs_loses_none(spark, monkeypatch):
    rows = spark.range(30).withColumn("run_id", (F.col("id") % 3).cast("int"))
    now, then = fresh(spark, "now")[0], fresh(spark, "then")[0]
    layout.write_table(rows, now, layout.Layout(partition_by=("run_id",)))
    layout.move_to_history(spark, now, then, "run_id", 0, 0, "a")
    layout.write_table(rows.filter("run_id = 0"), now, mode="append")
    real = type(spark).sql

    def sql(self, text, *args, **kw):
        if text.startswith(f"insert overwrite table {now}") and "run_id = 2" in text:
            raise Stopped
        return real(self, text, *args, **kw)

    with monkeypatch.context() as m:
        m.setattr(type(spark), "sql", sql)
        with pytest.raises(Stopped):
            layout.move_to_history(spark, now, then, "run_id", 1, 2, "b")
    layout.move_to_history(spark, now, then, "run_id", 1, 2, "b")
    got = {(r.batch_id, r.run_id): r["count"] for r in spark.table(then).groupBy("batch_id", "run_id").count().collect()}
    assert got == {("a", 0): 10, ("b", 1): 10, ("b", 2): 10} and spark.table(now).count() == 10


SCHEMA = "id int, name string"


def text(spark, lines):
    path = new_folder(spark, "text")
    spark.createDataFrame([(x,) for x in lines], "value string").repartition(3).write.text(path)
    return path


def test_a_load_reads_its_input_once(spark, monkeypatch):
    """The input is gone once it is staged: limits, both tables and a later addition need none of it."""
    from tidemark.sources import shared

    kept = load.stage
    monkeypatch.setattr(load, "stage", lambda rows, schema, folder: (kept(rows, schema, folder), [shared.remove_folder(spark, p) for p in inputs])[0])
    (name, path), (errors, error_path) = fresh(spark, "loaded"), fresh(spark, "errors")
    for n in (1, 2):
        inputs = [text(spark, ["1|a", "x|b", "3|c", "4|d"])]
        load.load(spark, inputs[0], SCHEMA, name, limit_rows=2, limit_percent=50, error_table=errors, table_path=path, error_path=error_path)
        assert not folder_exists(spark, inputs[0])
        assert sorted(tuple(r) for r in spark.table(name).collect()) == sorted([(1, "a"), (3, "c"), (4, "d")] * n)
        assert [r.line for r in spark.table(errors).collect()] == ["x|b"] * n
        assert all(r.file.endswith(".txt") for r in spark.table(errors).collect())
    assert spark.table(name).columns == ["id", "name"]


def test_a_load_over_its_limit_leaves_nothing(spark):
    (name, path), before = fresh(spark, "loaded"), None
    root = path.rsplit("/", 1)[0]
    source = text(spark, ["x|a", "y|b", "3|c"])
    before = subfolders(spark, root)
    with pytest.raises(load.RejectLimitExceeded):
        load.load(spark, source, SCHEMA, name, limit_percent=50, error_table=f"{name}_errors", table_path=path)
    assert subfolders(spark, root) == before and not spark.catalog.tableExists(name) and not spark.catalog.tableExists(f"{name}_errors")


@pytest.mark.parametrize("lines, n, bad", [(["1|a", "2|b"], 2, 0), (["x|a"], 0, 1), ([], 0, 0)])
def test_a_load_of_good_or_bad_rows_alone(spark, lines, n, bad):
    name, path = fresh(spark, "loaded")
    load.load(spark, text(spark, lines), SCHEMA, name, limit_percent=100, error_table=f"{name}_errors", table_path=path)
    assert (spark.table(name).count(), spark.table(f"{name}_errors").count()) == (n, bad)
