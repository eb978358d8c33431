"""Near duplicates against all pairs."""

import random
import re
from itertools import combinations

import pytest

from tidemark.llm import near_dups


def sets_of(rows):
    out = {}
    for doc_id, text in rows:
        w = [x for x in re.split(r"[\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or "")) if x]
        out.setdefault(doc_id, []).append(frozenset(tuple(w[j:j + 5]) for j in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else []))
    return out


def brute(rows, percent):
    sets = sets_of(r for r in rows if r[0] is not None)
    parent = {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in combinations(sorted(sets), 2):
        if any(x and y and 100 * len(x & y) >= percent * len(x | y) for x in sets[a] for y in sets[b]):
            p, q = sorted((root(a), root(b)))
            parent[q] = p
    return {i: root(i) for i in sets}


def words(rng, n):
    return [rng.choice("abcdefghij") + str(rng.randrange(400)) for _ in range(n)]


def edited(rng, text, n):
    out = list(text)
    for _ in range(n):
        out[rng.randrange(len(out))] = str(rng.randrange(10 ** 6))
    return out


def sample():
    rng = random.Random(3)
    rows, passage = [], words(rng, 30)
    for group in range(12):
        base = words(rng, rng.choice((3, 8, 60, 150)))
        rows += [base] + [edited(rng, base, rng.randrange(4)) for _ in range(4)]
    rows += [words(rng, 40) + passage + words(rng, 20) for _ in range(40)]
    chain = words(rng, 200)
    for _ in range(12):
        chain = edited(rng, chain, 3)
        rows.append(chain)
    texts = [" ".join(r) for r in rows]
    texts += ["", None, "   \n\t ", "one", "one", "One", texts[0].upper(), texts[0]]
    return list(enumerate(texts))


@pytest.mark.parametrize("small,percent", [(256, 85), (256, 80), (4, 85)])
def test_classes_equal_brute_force(spark, monkeypatch, small, percent):
    """With nodes of four texts at most, large nodes branch and are compared in blocks."""
    monkeypatch.setattr(near_dups, "SMALL", small)
    monkeypatch.setattr(near_dups, "DEPTH", 2)
    rows = sample()
    got = near_dups.linked_classes(spark.createDataFrame(rows, "doc_id long, text string"), percent).collect()
    want, sets = brute(rows, percent), sets_of(rows)
    assert {r.doc_id: r.component_id for r in got} == want
    assert all(r.n_shingles == len(sets[r.doc_id][0]) and r.kept == (r.doc_id == r.component_id) for r in got)


def test_nulls_repeats_and_other_columns(spark):
    rows = [(1, "a b c d e f", "x"), (1, "a b c d e f", "x"), (1, "p q r s t u", "y"), (2, "P Q R S T U", None), (None, "a b c d e f", "z"), (4, None, "k")]
    got = near_dups.linked_classes(spark.createDataFrame(rows, "doc_id long, text string, kept string")).collect()
    assert len(got) == 6
    assert {(r.doc_id, r.component_id, r.kept) for r in got} == {(1, 1, True), (2, 1, False), (None, None, True), (4, 4, True)}


def test_empty_table(spark):
    assert near_dups.linked_classes(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_long_chain_is_one_class(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(60)], "a long, b long")
    assert {r.label for r in near_dups.classes(links).collect()} == {0}
