"""Repetition by suffix arrays: against brute force and the statement, odd rows."""

import re
from collections import Counter

import numpy as np
import pyarrow as pa
from hypothesis import given, settings, strategies as st

from check import compare, open_duckdb
from conftest import DATA
from tidemark.llm import repetition
from tidemark.llm.repetition import MEASURES, Limits, measured, repeated_spans
from tidemark.llm.suffixes import suffix_order


def brute(text, limits=Limits()):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    n, least = len(words), limits.least_repeat
    repeats = lambda k: {i for i in range(n - k + 1) if any(words[i:i + k] == words[j:j + k] for j in range(n - k + 1) if j != i)}
    covered = {i + o for i in repeats(least) for o in range(least)}
    longest, k = 0, least
    while k <= n and repeats(k):
        longest, k = k, k + 1
    seen, again = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            again += line in seen
            seen.add(line)
    chars, hit = sum(map(len, words)), sum(len(words[i]) for i in covered)
    failed = n < limits.least_words or 100 * len(covered) > limits.repeated_words * n
    kept = not failed and 100 * hit <= limits.repeated_chars * chars and longest <= limits.longest_repeat
    return (n, chars, sum(c in "#*$%&|<>" for c in text), again, len(covered), failed, kept, hit, longest)


pieces = st.lists(st.sampled_from(["a", "b", "aa", "é", "#", "\n", "\n\n", " ", "\t", "the same five words again", "ab\x0bc", "\xa0", "€"]), max_size=60)


@given(st.lists(st.builds("".join, st.lists(st.sampled_from([" a", " b", " é", "\n", "a", " #&", " x y z", "\xa0", "\t"]), max_size=60)), max_size=8))
@settings(max_examples=80, deadline=None)
def test_measures_against_brute_force(texts):
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    offsets = np.concatenate(([0], np.cumsum([len(t.encode()) for t in texts]))).astype(np.int64)
    limits = Limits(least_repeat=3, least_words=2, repeated_words=60, repeated_chars=50, longest_repeat=4)
    found = repetition._measures(data, offsets, limits)
    got = list(zip(*[found[m].tolist() for m in MEASURES if m != "n_maximal"])) if texts else []
    assert got == [brute(t, limits) for t in texts]


@given(st.lists(st.lists(st.integers(0, 2), max_size=40), max_size=5))
@settings(max_examples=60, deadline=None)
def test_suffix_order(sequences):
    codes = np.array([x + 10 * r for r, s in enumerate(sequences) for x in s], np.int64)
    ends = np.array([e for s, e in zip(sequences, np.cumsum([len(s) for s in sequences])) for _ in s], np.int64)
    order, _ = suffix_order(codes, ends)
    assert order.tolist() == sorted(range(len(codes)), key=lambda i: codes[i:ends[i]].tolist())


def test_maximal_repeats_are_maximal():
    """Each span repeats, and its first occurrence cannot be made longer everywhere."""
    text = "p q r s t u x p q r s t u y r s t u v r s t u v"
    words = text.split()
    data = np.frombuffer(text.encode(), np.uint8)
    found = repetition.repeats_of(data, np.array([0, len(data)]), 4)
    spans = set(zip(*[a.tolist() for a in found.spans()]))
    assert spans == {(0, 6), (7, 6), (14, 5), (19, 5)}
    counts = Counter(" ".join(words[a:a + n]) for a, n in spans)
    assert all(c > 1 for c in counts.values())


def test_query_equals_statement(spark):
    ok, note = compare(repetition.op11_repetition(spark, DATA), open_duckdb(DATA), repetition.SQL)[:2]
    assert ok, note


def test_odd_rows(spark):
    rows = [(1, None, "x"), (2, "", "x"), (3, " \n\t ", "x"), (None, "one two three four five six seven eight nine ten", "x"), (4, "w " * 60000, "x"), (4, "w " * 60000, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_words string")
    got = [(r.doc_id, r.n_words, r.n_repeat_words, r.longest_repeat, r.kept) for r in measured(docs).collect()]
    assert sorted(got, key=str) == sorted([(1, 0, 0, 0, False), (2, 0, 0, 0, False), (3, 0, 0, 0, False), (None, 10, 0, 0, True),
                                           (4, 60000, 60000, 59999, False), (4, 60000, 60000, 59999, False)], key=str)
    assert measured(docs.limit(0)).count() == 0 and repeated_spans(docs.limit(0)).count() == 0


def test_spans_point_at_the_text(spark):
    text = "é one two three four five. Then é one two three four five. End"
    docs = spark.createDataFrame([(7, text), (8, None)], "doc_id long, text string")
    got = repeated_spans(docs).orderBy("first_word").collect()
    assert [(r.doc_id, r.first_word, r.n_words, text.encode()[r.start:r.end].decode()) for r in got] == [
        (7, 0, 6, "é one two three four five."), (7, 7, 6, "é one two three four five.")]


def test_texts_longer_than_a_chunk():
    text = (" ".join(f"w{i}" for i in range(120_000)) + " ") * 2
    data = np.frombuffer(text.encode(), np.uint8)
    found = repetition._measures(data, np.array([0, len(data)]), Limits())
    assert found["longest_repeat"].tolist() == [120_000] and found["n_repeat_words"].tolist() == [240_000]
    assert isinstance(pa.array(found["kept"]), pa.BooleanArray)
