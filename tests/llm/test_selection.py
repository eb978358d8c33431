"""Mixing, URL rules, sharding and decontamination on small tables."""

import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from check import compare, open_duckdb
from conftest import DATA
from tidemark.llm import decontaminate, mixing, queries, sharding, url_filter


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_statements(spark, name):
    ok, note = compare(queries.QUERIES[name](spark, "/root/testdata/sf0.01"), open_duckdb("/root/testdata/sf0.01"), queries.SQL[name])
    assert ok, note


def test_targets_are_met(spark):
    got = mixing.op3_mixing(spark, "/root/testdata/sf0.1").toPandas()
    source = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").select("doc_id", "source").toPandas()
    by = got.merge(source, on="doc_id").groupby("source").agg(target=("target", "first"), taken=("taken", "sum"), size=("size", "sum"))
    assert (abs(by.taken - by.target) <= 0.01 * by.target).all()
    assert (got.taken <= 2 * got["size"]).all() and abs(by.target.sum() - 1.5 * by["size"].sum()) < 1e-3


def test_mix_of_odd_rows(spark):
    rows = [(1, None, "a b c", 1), (1, None, "a b c", 1), (2, "s", None, 2), (3, "s", "", 3), (None, "t", "x " * 50, 4), (5, "t", "y " * 9, 5), (6, "t", "z", 6)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string, whole int")
    got = mixing.mixed(docs).collect()
    assert len(got) == len(rows) and all(0 <= r.mix_copies <= 2 for r in got)
    assert all(r.mix_copies == 0 for r in got if not (r.text or "").strip())
    assert got[0].whole is not None and sorted(got, key=str) == sorted(mixing.mixed(docs).collect(), key=str)
    assert mixing.mixed(docs.limit(0)).count() == 0


def test_one_source_may_hold_most_rows(spark):
    docs = spark.range(20000).selectExpr("id as doc_id", "if(id % 10 < 9, 'big', concat('s', id % 70)) as source", "repeat('w ', cast(1 + id % 37 as int)) as text")
    by = mixing.mixed(docs).groupBy("source").agg({"mix_target": "first"}).count()
    assert by == 8
    sums = mixing.mixed(docs).selectExpr("source", "mix_target t", "mix_copies * mix_size k").groupBy("source", "t").sum("k").collect()
    assert all(abs(r["sum(k)"] - r.t) < 40 for r in sums)


URLS = ["http://a.org/x", "HTTP://X.Example.ORG/es/1", "https://example.org/en/12?q#f", "https://example.org/en/2", "http://com/de/", "http://b.com/fr/x", "http://b.com/fr", None, "no scheme", "http://",
        "http://spam-farm.net/a/?utm_source=x&b=2&a=1#t", "https://www.spam-farm.net:443/a?a=1&b=2", "http://other.net/a?a=1&b=2", "http://notexample.org/es/", "http://x.net/\nline", "x://h.net/p://q"]


def test_url_rules_and_list(spark):
    pages = spark.createDataFrame([(i, u, 0) for i, u in enumerate(URLS)] + [(10, URLS[10], 0)], "page_id long, url string, block int")
    got = {r.page_id: r for r in url_filter.judged(pages, spark.createDataFrame([(URLS[10],), (URLS[10],), (None,)], "u string")).collect()}
    assert [got[i].rule for i in range(7)] == ["org/", "example.org/es/", "example.org/en/1", "org/", "com/de/", "com/fr/", None]
    assert [got[i].verdict for i in range(16)] == ["allow", "block", "block", "allow", "block", "allow", "allow", "allow", "allow", "allow", "block", "block", "allow", "allow", "allow", "allow"]
    assert (got[7].host, got[7].path, got[8].host) == ("", "", "") and (got[1].host, got[14].path, got[15].host) == ("x.example.org", "/\nline", "h.net")
    assert {r.verdict for r in url_filter.judged(pages, spark.createDataFrame([], "u string")).filter("page_id = 10").collect()} == {"allow"}
    assert url_filter.judged(pages.limit(0), pages.select("url")).count() == 0


def test_bloom_filter_has_no_false_negatives_and_few_false_hits(spark):
    listed = spark.range(3000).selectExpr("concat('h', id, '.net/') as listed")
    blocks = 256
    bloom = url_filter.bloom_blocks(listed, blocks)
    from pyspark.sql import functions as F

    probe = spark.range(6000).selectExpr("id", "concat('h', id, '.net/') as listed").withColumn("block", F.pmod(F.xxhash64("listed"), F.lit(blocks))).join(bloom, "block", "left")
    ok = F.lit(True)
    for i, m in enumerate(url_filter._masks(F.col("listed"))):
        ok = ok & (F.coalesce(F.col(f"w{i}"), F.lit(0).cast("long")).bitwiseAND(m) == m)
    hit = Counter(r.id < 3000 for r in probe.filter(ok).collect())
    assert hit[True] == 3000 and hit[False] < 60


@pytest.mark.parametrize("cell", [20_000, 60])
def test_shards(spark, monkeypatch, cell):
    """With cells of 60 groups, packing takes several levels."""
    monkeypatch.setattr(sharding, "CELL", cell)
    got = sharding.op5_sharding(spark, "/root/testdata/sf0.01").toPandas()
    by = got.groupby("shard").agg(size=("size", "sum"), n=("doc_id", "count"), slots=("slot", "nunique"), last=("slot", "max"))
    assert len(got) == 1000 and set(got["shard"]) == set(range(40))
    assert (by.slots == by.n).all() and (by["last"] + 1 == by.n).all()
    assert by["size"].max() < (1.1 if cell > 60 else 1.6) * by["size"].mean()


def test_many_shards_of_few_groups(spark):
    """More shards than groups, and cells with fewer groups than bins: levels must shrink."""
    rows = spark.range(3000).selectExpr("id as doc_id", "concat('text ', id) as text")
    got = sharding.sharded(rows, 5000).toPandas()
    assert len(got) == 3000 and got.groupby("shard").size().max() == 1


@pytest.mark.parametrize("groups, shards", [(1000, 40), (6000, 600), (900, 100)])
def test_levels_shrink(spark, monkeypatch, groups, shards):
    monkeypatch.setattr(sharding, "CELL", 60)
    rows = spark.range(groups).selectExpr("id as doc_id", "concat('some words of text ', id) as text")
    got = sharding.sharded(rows, shards).groupBy("shard").count().toPandas()
    assert got["count"].sum() == groups and len(got) == shards


def test_packing_against_brute_force():
    """Each item goes where the product of its measures with the room left is highest."""
    rng = np.random.default_rng(3)
    for bins in (1, 3, 10):
        m = rng.random((200, 3))
        m /= m.sum(axis=0)
        room, want = [[1 / bins] * 3 for _ in range(bins)], {}
        for i in sorted(range(200), key=lambda i: (-max(m[i]), i)):
            products = [sum(r * x for r, x in zip(row, m[i])) for row in room]
            want[i] = max(range(bins), key=lambda b: (products[b], -b))
            room[want[i]] = [r - x for r, x in zip(room[want[i]], m[i])]
        assert sharding.pack(m, bins).tolist() == [want[i] for i in range(200)]


def test_shards_of_odd_rows(spark, monkeypatch):
    monkeypatch.setattr(sharding, "NUMBERED", 20)
    rows = [(i, "same text " * 50) for i in range(3000)] + [(i, f"t {i}") for i in range(3000, 4000)] + [(None, None), (None, ""), (7, "x"), (7, "x")]
    got = sharding.sharded(spark.createDataFrame([(*r, 0) for r in rows], "doc_id long, text string, shard int")).toPandas()
    by = got.groupby("shard").agg(size=("size", "sum"), n=("slot", "count"), slots=("slot", "nunique"), last=("slot", "max"))
    assert len(got) == len(rows) and (by.slots == by.n).all() and (by["last"] + 1 == by.n).all()
    assert by["size"].max() < 1.3 * by["size"].mean()
    assert sharding.sharded(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def words(text):
    return re.findall(r"[^\W_]+", (text or "").lower())


def test_contaminated_documents(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.1/documents.parquet").select("doc_id", "text").collect()]
    items = {r.item_id: words(r.text) for r in spark.read.parquet("/root/testdata/sf0.1/benchmark.parquet").collect()}
    runs = defaultdict(set)
    for i, w in items.items():
        for j in range(len(w) - 4):
            runs[tuple(w[j:j + 5])].add(i)
    want = set()
    for d, text in docs:
        w, n = words(text), Counter()
        for run in {tuple(w[j:j + 5]) for j in range(len(w) - 4)}:
            n.update(runs.get(run, ()))
        want |= {(d, i) for i, k in n.items() if k >= 0.8 * len({tuple(items[i][j:j + 5]) for j in range(len(items[i]) - 4)})}
    got = {(r.doc_id, r.item_id) for r in decontaminate.op10_decontamination(spark, "/root/testdata/sf0.1").collect()}
    assert got == want and len(got) > 100


def test_contamination_of_odd_rows(spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "SEGMENTS", 2)
    monkeypatch.setattr(decontaminate, "PASS_BYTES", 300)
    question = "What is the name of the river that flows through the old town of the north"
    long_item = " ".join(f"w{i}" for i in range(200))
    items = [(1, question, "The Tide."), (2, long_item, ""), (3, None, None), (4, "", "?!"), (5, "cold metal rings under seven quiet stars tonight", "yes")]
    docs = [(1, f"x y z {question.upper()}?? the TIDE and more"), (2, question), (3, "a b " * 100 + long_item + " c d" * 100), (4, None), (5, ""), (6, "What is the name of the game"),
            (None, f"{question} the tide"), (8, " ".join(f"w{i}" for i in range(0, 200, 2)))]
    got = decontaminate.contaminated(spark.createDataFrame([(*d, 1) for d in docs], "doc_id long, text string, score int"), spark.createDataFrame(items, "item_id long, question string, answer string")).collect()
    assert {(r.doc_id, r.item_id) for r in got} == {(1, 1), (2, 1), (3, 2), (None, 1)}
    assert {r.doc_id: r.answer_overlap for r in got if r.item_id == 1} == {1: 1.0, 2: 0.0, None: 1.0}
    none = spark.createDataFrame([], "item_id long, question string, answer string")
    assert decontaminate.contaminated(spark.createDataFrame(docs, "doc_id long, text string"), none).count() == 0


def test_search_finds_all_above_the_threshold():
    import random

    import numpy as np

    rng = random.Random(5)
    segments = [np.array([rng.randrange(60) for _ in range(rng.randrange(5, 40))], np.uint64) for _ in range(70)]
    frequency = Counter(w for s in segments for w in set(s.tolist()))
    index, = decontaminate.Index.build(list(range(70)), segments, [np.zeros(0, np.uint64)] * 70, frequency, 70, 20.0)
    for _ in range(100):
        terms = rng.sample(range(len(index.terms)), rng.randrange(1, 40))
        for least in (0.2, 0.5, 0.7):
            score = Counter()
            for t in terms:
                score.update(dict(zip(index.ids[t], index.impacts[t])))
            want = {s: v for s, v in score.items() if v >= least + 1e-9}
            found = dict(index.retrieve(terms, least))
            assert set(want) <= set(found) and all(abs(found[s] - want[s]) < 1e-9 for s in want)


def test_mix_of_rows_without_or_with_equal_ids(spark):
    """Rows draw by id and text, so that targets are met whatever the ids are."""
    for doc_id in (None, 5):
        rows = [(doc_id, f"s{i % 3}", " ".join(f"w{i}x{j}" for j in range(1 + i * 7 % 23))) for i in range(3000)]
        docs = spark.createDataFrame(rows, "doc_id long, source string, text string")
        got = mixing.mixed(docs).groupBy("source").agg({"mix_target": "first", "mix_copies": "max"}).collect()
        taken = {r.source: r.n for r in mixing.mixed(docs).selectExpr("source", "mix_copies * mix_size as n").groupBy("source").agg({"n": "sum"}).withColumnRenamed("sum(n)", "n").collect()}
        assert len(got) == 3 and all(abs(taken[r.source] - r["first(mix_target)"]) <= 0.01 * r["first(mix_target)"] and r["max(mix_copies)"] <= 2 for r in got)


def test_items_without_ids_are_spread_over_passes(spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "PASS_BYTES", 400)
    items = [(None, " ".join(f"q{i}w{j}" for j in range(12)), f"a{i}") for i in range(30)]
    frame = spark.createDataFrame(items, "item_id long, question string, answer string")
    from tidemark.sources.shared import new_folder

    passes = [sum(len(index.items) for index in own) for own in decontaminate.indexes(frame, new_folder(spark, "passes"))]
    assert sum(passes) == 30 and max(passes) < 15
    docs = spark.createDataFrame([(i, f"x y {q} z") for i, (_, q, _) in enumerate(items)], "doc_id long, text string")
    assert sorted(r.doc_id for r in decontaminate.contaminated(docs, frame).collect()) == list(range(30))
