"""Fingerprints, archives and the pipeline."""

import hashlib
import zlib

import corpus_pipeline
from pyspark.sql import functions as F
from tidemark.llm import fingerprints, warc
from tidemark.sources.shared import new_folder


def test_edited_texts_and_likeness(spark):
    got = fingerprints.op9_fingerprints(spark, "/root/testdata/sf0.01").collect()
    docs = {r.doc_id: r.text for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()}
    ids = sorted(docs, reverse=True)
    after = dict(zip(ids, ids[1:] + ids[:1]))
    prints = {r.doc_id: r.fingerprint for r in got}
    for r in got:
        text, following = docs[r.doc_id], docs[after[r.doc_id]]
        half = len(text) // 2
        assert r.edited_sha256 == hashlib.sha256((text[:len(text) - half] + following[:half]).encode()).hexdigest() and r.n_chars == len(text)
        a, b = ({x[i:i + 6] for i in range(0, len(x), 6)} for x in (prints[r.doc_id], prints[after[r.doc_id]]))
        assert abs(r.near_next - (len(a & b) / len({x[:2] for x in a | b}) if a | b else 1.0)) < 1e-9
    by_text = {}
    assert all(by_text.setdefault(docs[r.doc_id], r.fingerprint) == r.fingerprint for r in got)
    assert sum(r.near_edited for r in got) > 50 * sum(r.near_next for r in got)


def prints_of(spark, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, text string")
    return [r.p for r in fingerprints.with_fingerprint(df, "text", "p").orderBy("i").collect()]


def test_order_and_repeats_count(spark):
    words = [f"w{i}" for i in range(400)]
    same, moved = " ".join(words), " ".join(words[200:] + words[:200])
    few = " ".join(words[:395] + ["x", "y", "z", "u", "v"])
    twice = " ".join(words[:20] * 2)
    p = prints_of(spark, [same, moved, few, " ".join(words[:20]), twice, None, "", "   ", "one", "one two", same])
    like = lambda a, b: len(set(a) & set(b)) / max(1, len({v >> 16 for v in [*a, *b]}))
    assert like(p[0], p[2]) > 0.8 > like(p[0], p[1]) > 0.2
    assert like(p[3], p[4]) < 1 and p[5] == p[6] == p[7] == [] and len(p[8]) == 1 and p[0] == p[10]


def test_occurrences_are_numbered(spark):
    """A text of one repeated k-mer has as many k-mers as places."""
    a, b = prints_of(spark, ["a " * 3, "a " * 300])
    assert len(a) <= 2 and len(b) > 40


def test_next_rows_over_blocks(spark, monkeypatch):
    monkeypatch.setattr(fingerprints, "BLOCK_ROWS", 3)
    ids = [5, 1, 900, 901, 902, 903, 17, 18, 400, -7, None]
    docs = spark.createDataFrame([(i, f"t{i}", "c") for i in ids], "doc_id long, text string, block string")
    got = {r.text: r.next_text for r in fingerprints.with_next(docs, "text").collect()}
    order = [f"t{i}" for i in sorted([i for i in ids if i is not None], reverse=True)] + ["tNone"]
    assert got == dict(zip(order, order[1:] + order[:1]))
    assert fingerprints.with_next(docs.filter("doc_id = 5"), "text").first().next_text == "t5"
    assert fingerprints.with_next(docs.limit(0), "text").count() == 0


PAYLOAD = "<html>" + "ä" * 1000
PAGES = [(1, "http://a/x?y#z", PAYLOAD), (9, "http://b", PAYLOAD), (4, None, PAYLOAD), (4, None, PAYLOAD), (5, "http://c/\r\nX", "short\r\n\r\nWARC/1.1\r\n"), (6, "u", "short\r\n\r\nWARC/1.1\r\n"),
         (7, "v", None), (8, "v", ""), (None, "http://d/", "Content-Length: 5"), (10, "http://e/", "\r\n\r\n")]


def test_archives_round_trip(spark):
    folder = new_folder(spark, "warc")
    warc.write_archives(spark.createDataFrame([(*p, "n") for p in PAGES], "page_id long, url string, html string, top string"), f"{folder}/a", f"{folder}/w")
    got = warc.assembled(warc.read_records(spark, f"{folder}/a")).collect()
    assert len(got) == len(PAGES)
    payloads = sorted((r.metadata.page_id or -1, bytes(r.response.block).partition(b"\r\n\r\n")[2].decode()) for r in got if r.kind == "response")
    assert payloads == sorted((p or -1, h or "") for p, _, h in PAGES if h != PAYLOAD or p == 9)
    again = [r for r in got if r.kind == "revisit"]
    assert sorted(r.metadata.page_id for r in again) == [1, 4, 4] and {r.original.page_id for r in again} == {9}
    assert all(r.request is not None and r.n_request == 1 for r in got)
    assert {r.response.uri for r in got if r.metadata.page_id == 5} == {"http://c/%0D%0AX"}


def test_records_of_several_members_and_broken_ones():
    import gzip

    import pytest

    record = b"WARC/1.1\r\nWARC-Type: response\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"
    assert [b for _, b in warc.records_of(gzip.compress(record) + gzip.compress(record))] == [b"abc", b"abc"]
    with pytest.raises(ValueError):
        list(warc.records_of(record.replace(b": 3", b": 2")))


def test_missing_records(spark):
    rows = [("response", "r1", None, None, "u", 3, "d", None, None), ("metadata", "m1", "r1", None, "u", None, None, 4, None), ("metadata", "m0", "r1", None, "u", None, None, 5, None),
            ("request", "q", "gone", None, "u", None, None, None, None), ("revisit", "v", None, "lost", "u", None, None, None, None)]
    got = {r.capture: r for r in warc.assembled(spark.createDataFrame(rows, warc.RECORD)).collect()}
    assert set(got) == {"r1", "v"} and got["r1"].metadata.page_id == 5 and got["r1"].n_metadata == 2 and got["r1"].request is None
    assert got["v"].original is None


def test_pipeline_against_brute_force(spark):
    folder = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    extra = spark.createDataFrame([(-1, None, None, None, None), (-2, "12 34", "en", "src1", 5), (None, "only one of this text here and now", "en", None, 1), (None, "only one of this text here and now", "en", None, 1)], docs.schema)
    docs, kept = docs.unionByName(extra).withColumn("score", F.lit(1)), {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = {(r.doc_id, r.text) for r in docs.collect()}
        docs = spark.createDataFrame(stage(spark, docs, folder).collect(), docs.schema)
        after = [(r.doc_id, r.text) for r in docs.collect()]
        assert set(after) <= before
        kept[name] = (before, after)
    before, after = kept["language"]
    assert before - set(after) == {(-1, None), (-2, "12 34")}
    from test_near_dups import brute

    before, after = kept["near_duplicates"]
    rows = [(zlib.crc32(t.encode()) - 2 ** 40 if d is None else d, t) for d, t in before]
    classes = brute(rows, 80)
    assert sorted(zlib.crc32(t.encode()) - 2 ** 40 if d is None else d for d, t in after) == sorted(set(classes.values()))
    before, after = kept["decontamination"]
    items = [" ".join(r.text.lower().split()) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    holding = {(d, t) for d, t in before if any(i in " ".join(t.lower().split()) for i in items)}
    assert holding and not holding & set(after) and len(before) - len(after) <= 1.2 * len(holding)
    before, after = kept["mixing"]
    assert len(after) > len(before) > len(set(after)) * 0.9 and max(after.count(x) for x in set(after)) == 2
    last = corpus_pipeline.STAGES[-1][1](spark, docs, folder)
    assert last.count() == len(after)


def test_rows_of_one_id_with_different_texts_stay(spark):
    one, two = "the first text is about rivers and old towns of the north", "another one tells of seven quiet stars and cold metal rings"
    rows = [(1, one, "en"), (1, two, "en"), (1, two, "de"), (2, one, "en"), (3, None, "en"), (3, "short", "en"), (None, two, "en"), (None, "nothing else", "en"), (None, "nothing else", "en")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    left = corpus_pipeline.remove_near_duplicates(spark, docs, "")
    assert left.columns == docs.columns
    got = sorted(((r.doc_id, r.text) for r in left.collect()), key=str)
    assert len(got) == 5 and len({t for _, t in got}) == 5 and {(3, None), (3, "short"), (None, "nothing else")} <= set(got)
    held = " ".join(spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet").first().text.split())
    docs = spark.createDataFrame([(1, held), (1, one)], "doc_id long, text string")
    assert [r.text for r in corpus_pipeline.remove_contaminated(spark, docs, "/root/testdata/sf0.001").collect()] == [one]


def test_training_rows_are_a_bounded_sample(spark):
    from tidemark.llm.samples import least_hashed, window_at

    rows = spark.range(5000).select(F.xxhash64("id").alias("h"), F.concat_ws(" ", F.sequence(F.lit(1), F.lit(300))).alias("text")).repartition(16)
    got = least_hashed(rows, 100)
    assert [r.h for r in got] == sorted(r.h for r in rows.collect())[:100]
    assert len(least_hashed(rows, 9000)) == 5000
    starts = {r.w for r in rows.select(window_at("text", 5, F.xxhash64("h")).alias("w")).collect()}
    assert len(starts) > 500 and all(len(w) == 5 for w in starts)
    short = spark.createDataFrame([("abc",), ("",)], "text string").select(window_at("text", 5, F.lit(7)).alias("w")).collect()
    assert [r.w for r in short] == ["abc", ""]
