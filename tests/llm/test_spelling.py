"""Spelling variants: the index against all pairs, the query against brute force."""

import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from conftest import DATA
from tidemark.llm import spelling
from tidemark.llm.fm_index import Vocabulary
from tidemark.llm.spelling import spelling_variants


def one_error(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:k] + b[k + 1:] == a for k in range(len(b)))


@given(st.sets(st.lists(st.sampled_from("abcÿ×"), min_size=1, max_size=9).map("".join), min_size=1, max_size=40))
@settings(max_examples=150, deadline=None)
def test_search_finds_each_word_with_one_error(vocabulary):
    words = sorted(w.encode("latin-1") for w in vocabulary)
    index = Vocabulary(words)
    half = np.array([len(w) // 2 for w in words])
    for right_exact in (False, True):
        i, j = index.with_one_error(words, half, right_exact)
        keeps = (lambda w, x: x.endswith(w[len(w) // 2:]) and one_error(w[:len(w) // 2], x[:len(x) - len(w) + len(w) // 2])) if right_exact else (
            lambda w, x: x.startswith(w[:len(w) // 2]) and one_error(w[len(w) // 2:], x[len(w) // 2:]))
        assert list(zip(i.tolist(), j.tolist())) == [(a, b) for a, w in enumerate(words) for b, x in enumerate(words) if keeps(w, x)]


def expected(rows):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 31 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            counts[run] += 1
    counts = {w: n for w, n in counts.items() if len(w) >= 7 and n >= 2}
    shorter = defaultdict(set)
    for w in counts:  # two words one error apart share a word with one code point less
        for k in range(len(w)):
            shorter[w[:k] + w[k + 1:]].add(w)
    near = {w: {x for k in range(len(w)) for x in shorter[w[:k] + w[k + 1:]] | ({w[:k] + w[k + 1:]} & counts.keys())} | shorter[w] for w in counts}
    near = {w: {x for x in found if one_error(w, x)} for w, found in near.items()}
    form = {}
    for w, found in near.items():
        best = min(found, key=lambda x: (-counts[x], x), default=None)
        form[w] = best if best is not None and counts[best] >= 10 * counts[w] else None
    out = []
    for w in counts:
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, counts[w], len(near[w]), counts[form[w]] if form[w] else None))
    return sorted(out)


def test_query_equals_brute_force(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text").collect()
    got = sorted(tuple(r) for r in spelling.op13_spelling(spark, DATA).collect())
    assert got == expected([tuple(r) for r in docs]) and any(r[1] for r in got)


def rows():
    rng = np.random.default_rng(5)
    base = ["commonly", "Commonly", "comment", "comments", "aaaaaaa", "éééééééé", "interest×", "ÀÉÎÕÜßÿ", "stringing", "straining"]
    out = []
    for i in range(1500):
        w = base[int(rng.integers(len(base)) * rng.random())]
        if rng.random() < 0.2:
            k = int(rng.integers(len(w)))
            w = w[:k] + "aeß"[int(rng.integers(3))] * int(rng.integers(2)) + w[k + int(rng.integers(2)):]
        out.append((i % 97, f"{w} the {w.upper()}9{w}\n" * int(rng.integers(1, 4))))
    return [*out, (None, "commonly commonly nothing nothing"), (None, None), (3, ""), (4, "  \n"), (5, "x" * 40_000 + " " + "x" * 40_000), (5, "x" * 39_999 + " " + "x" * 39_999)]


@pytest.mark.parametrize("part", [spelling.PART, 5])
def test_odd_rows_and_halves_in_blocks(spark, part):
    """Blocks of five words: nearly every half is cut."""
    docs = spark.createDataFrame([(*r, "x", 1) for r in rows()], "doc_id long, text string, word string, n int")
    assert sorted(tuple(r) for r in spelling_variants(docs, part).collect()) == expected(rows())


def test_chains_of_forms(spark):
    chain = ["abcdefgh", "abcdefgi", "abcdefji", "abcdekji"]
    forms = spark.createDataFrame(list(zip(chain, chain[1:])) + [("other", "others")], "word string, form string")
    from tidemark.sources.shared import new_folder

    got = {r.word: r.root for r in spelling.roots(forms, new_folder(spark, "roots")).collect()}
    assert got == {**{w: chain[-1] for w in chain[:-1]}, "other": "others"}


def test_empty_table(spark):
    assert spelling_variants(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    assert spelling_variants(spark.createDataFrame([(1, None)], "doc_id long, text string")).count() == 0
