"""Facts in months, weeks and an open span: names, ranges, upserts, changes of grains, replays."""

import datetime as dt
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from tidemark.sources import spans
from tidemark.sources.shared import new_folder
from tidemark.sources.spans import Grains, SpanFact
from tidemark.streaming import replay

GRAINS = Grains("2009-12-05", "2010-02-10", "2010-03-05", "2010-03-20")
SCHEMA = "id long, at timestamp_ntz, v int"


def day(text):
    return dt.datetime.fromisoformat(text)


def rows_from(spark, first, n, step_hours=7, v=1, start=0):
    return spark.range(start, start + n).select("id", F.expr(f"timestamp_ntz '{first}' + make_dt_interval(0, cast((id - {start}) * {step_hours} as int))").alias("at"), F.lit(v).alias("v"))


def make(spark, rows, grains=GRAINS):
    path = new_folder(spark, "fact")
    return SpanFact.create(rows, path.rsplit("/", 1)[1].replace("-", "_"), "at", "id", grains, path=path)


def content(fact):
    return sorted((r.id, r["at"], r.v) for r in fact.rows().collect())


def by_span(fact):
    return {r.span: r["count"] for r in fact.stored().groupBy("span").count().collect()}


def test_names_of_all_days(spark):
    want = {a + dt.timedelta(days=i): name for name, a, b in GRAINS.spans() for i in range((b - a).days)}
    days = [dt.date(2009, 11, 28) + dt.timedelta(days=i) for i in range(130)]
    frame = spark.createDataFrame([(dt.datetime.combine(d, dt.time(23, 59)),) for d in days] + [(None,)], "at timestamp_ntz")
    got = {r["at"]: r.name for r in frame.select("at", GRAINS.name_of("at").alias("name")).collect()}
    assert {d: got[dt.datetime.combine(d, dt.time(23, 59))] for d in days} == {d: want.get(d, GRAINS.outside) for d in days}
    assert got[None] == GRAINS.outside and len(want) == 105
    assert [n for n in GRAINS.names()][:4] == ["month_2009-12-05_2010-01-01", "month_2010-01-01_2010-02-01", "month_2010-02-01_2010-02-10", "week_2010-02-10_2010-02-17"]
    with pytest.raises(ValueError):
        Grains("2010-01-01", "2009-01-01", "2010-01-01", "2010-01-01")


def test_a_range_scans_its_spans(spark):
    rows = rows_from(spark, "2009-12-01 00:00:00", 400)
    fact = make(spark, rows)
    got = fact.rows("2010-01-30 12:00:00", "2010-02-12 00:00:00")
    want = rows.filter("at >= timestamp_ntz '2010-01-30 12:00:00' and at < timestamp_ntz '2010-02-12'")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    folders = {f.split("span=")[1].split("/")[0] for f in got.inputFiles()}
    assert folders == {"month_2010-01-01_2010-02-01", "month_2010-02-01_2010-02-10", "week_2010-02-10_2010-02-17", GRAINS.outside}
    assert fact.rows().count() == 400


def test_upserts_add_replace_and_repeat(spark):
    fact = make(spark, rows_from(spark, "2010-03-01 00:00:00", 20))
    more = rows_from(spark, "2010-03-06 20:00:00", 30, v=2, start=20)
    want = {r.id: tuple(r) for r in [*rows_from(spark, "2010-03-01 00:00:00", 20).collect(), *more.collect()]}
    for _ in range(2):
        fact.upsert(more, "b1")
        assert content(fact) == sorted(want.values())
    # some rows of the first load and of b1, all of a span's folder among them, and a key twice
    again = spark.createDataFrame([(i, want[i][1], 9) for i in (0, 1, 25, 26, 26)] + [(99, None, 3)], SCHEMA)
    for _ in range(2):
        fact.upsert(again, "b2")
        assert content(fact) == sorted([*({**want, **{i: (i, want[i][1], 9) for i in (0, 1, 25, 26)}}).values(), (99, None, 3)], key=lambda r: r[0])
    every = spark.createDataFrame([(i, w[1], 7) for i, w in want.items()], SCHEMA)
    fact.upsert(every, "b3")
    fact.upsert(every.limit(0), "b4")
    assert content(fact) == sorted([(i, w[1], 7) for i, w in want.items()] + [(99, None, 3)], key=lambda r: r[0])
    assert spark.table(fact.table).filter("batch <> 'b3'").count() == 1


@pytest.mark.parametrize("stop", [None, "_set", "drop_waste"])
def test_changes_of_grains_keep_all_rows(spark, monkeypatch, stop):
    """Also if the job stops before or after the new grains are in force, and is started again."""
    fact = make(spark, rows_from(spark, "2009-11-20 00:00:00", 450))
    fact.upsert(rows_from(spark, "2010-03-18 01:00:00", 40, v=2, start=1000), "late")
    want = content(fact)
    then = Grains("2009-12-05", "2010-03-01", "2010-03-18", "2010-04-30")
    if stop:
        class Stopped(Exception):
            pass

        def fail(*_):
            raise Stopped

        with monkeypatch.context() as m:
            m.setattr(SpanFact, stop, fail)
            with pytest.raises(Stopped):
                fact.roll_over(then)
        assert content(fact) == want
    fact.roll_over(then)
    assert content(fact) == want and fact.grains() == then
    left = spark.table(fact.table).select("span").distinct().collect()
    assert {r.span for r in left} <= set(then.names()) and set(by_span(fact)) <= set(then.names())
    fact.roll_over(GRAINS)
    assert content(fact) == want


def test_a_scan_during_a_change_sees_each_row_once(spark, monkeypatch):
    fact = make(spark, rows_from(spark, "2009-12-20 00:00:00", 300))
    seen = []
    kept = SpanFact._set
    monkeypatch.setattr(SpanFact, "_set", lambda self, g: (seen.append(fact.rows().count()), kept(self, g), seen.append(fact.rows().count())))
    fact.roll_over(replace(GRAINS, monthly_end="2010-03-01"))
    assert seen == [300, 300] and spans.MERGED in {r.batch for r in fact.stored().select("batch").distinct().collect()}


def test_a_replay_survives_a_stop(spark):
    """Stopped after a batch is stored and before it is committed: the batch comes again."""
    first, later = rows_from(spark, "2010-03-01 00:00:00", 12), rows_from(spark, "2010-03-06 00:00:00", 60, v=2, start=12)
    fact = make(spark, first)
    held, inbox, checkpoint = (new_folder(spark, n) for n in ("held", "inbox", "cp"))
    replay.hold_out(later, "at", held)
    days = replay.days_held(spark, held)
    assert len(days) == 18 and days == sorted(days)
    assert replay.deliver(spark, held, inbox, 10) == days[:10]

    def stop(batch_id):
        if batch_id == 1:
            raise RuntimeError("lost")

    with pytest.raises(Exception, match="lost"):
        replay.replay(spark, inbox, SCHEMA, fact, checkpoint, files_per_batch=3, loaded=stop).awaitTermination()
    assert 12 < fact.rows().count() < 72
    while replay.deliver(spark, held, inbox, 5):
        replay.replay(spark, inbox, SCHEMA, fact, checkpoint, files_per_batch=3).awaitTermination()
    replay.replay(spark, inbox, SCHEMA, fact, checkpoint, files_per_batch=3).awaitTermination()  # nothing new
    want = sorted(map(tuple, first.unionByName(later).collect()))
    assert content(fact) == want and replay.days_held(spark, held) == []
    # the same days as another stream replace what the first brought
    replay.replay(spark, inbox, SCHEMA, fact, new_folder(spark, "cp2")).awaitTermination()
    assert content(fact) == want


def test_a_paced_replay_looks_again(spark):
    fact = make(spark, rows_from(spark, "2010-03-01 00:00:00", 5))
    held, inbox = new_folder(spark, "held"), new_folder(spark, "inbox")
    replay.hold_out(rows_from(spark, "2010-03-06 00:00:00", 20, v=2, start=5), "at", held)
    replay.deliver(spark, held, inbox, 1)
    query = replay.replay(spark, inbox, SCHEMA, fact, new_folder(spark, "cp"), every="200 milliseconds")
    query.processAllAvailable()
    some = fact.rows().count()
    replay.deliver(spark, held, inbox, 100)
    query.processAllAvailable()
    query.stop()
    assert 5 < some < 25 and fact.rows().count() == 25


@pytest.mark.parametrize("gathered", [False, True])
def test_rows_put_apart_by_day(spark, gathered):
    rows = rows_from(spark, "2009-12-01 00:00:00", 400)
    none = spark.createDataFrame([(1000, None, 1)], SCHEMA)
    path, apart = new_folder(spark, "fact"), new_folder(spark, "apart")
    fact = SpanFact.create_apart(rows.unionByName(none), path.rsplit("/", 1)[1].replace("-", "_"), "at", "id", GRAINS, "2010-03-15 10:00:00", path, apart, replay.DAY, gathered=gathered)
    want = sorted(map(tuple, rows.collect()))
    assert content(fact) == [r for r in want if r[1] < day("2010-03-15 10:00:00")] and fact.grains() == GRAINS
    assert set(by_span(fact)) <= set(GRAINS.names())
    held = sorted((r.id, r["at"], r.v, r[replay.DAY]) for r in spark.read.parquet(apart).collect())
    assert held == [(*r, r[1].date()) for r in want if r[1] >= day("2010-03-15 10:00:00")] and held
    fact.upsert(rows.filter("id = 0").withColumn("v", F.lit(5)), "again")
    assert [r[2] for r in content(fact) if r[0] == 0] == [5]
    # nothing to put apart
    whole = SpanFact.create_apart(rows, f"{fact.table}_w", "at", "id", GRAINS, "2020-01-01", new_folder(spark, "fact"), empty := new_folder(spark, "apart"), replay.DAY)
    assert content(whole) == want and replay.days_held(spark, empty) == []
