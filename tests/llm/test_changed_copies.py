"""Test items that a text holds with some words changed, or without the answer."""

import random

from tidemark.llm import decontaminate
from test_selection import words

FOLDER = "/root/testdata/sf0.1"


def test_changed_copies_and_questions_alone(spark):
    items = decontaminate.benchmark_items(spark, FOLDER)
    rows = [(r.item_id, words(r.question), words(r.answer)) for r in items.collect()]
    rng = random.Random(3)
    filler = [w for r in spark.read.parquet(f"{FOLDER}/documents.parquet").orderBy("doc_id").limit(300).collect() for w in words(r.text)]
    rng.shuffle(filler)

    def around(own):
        a, b = rng.randrange(len(filler) - 300), rng.randrange(len(filler) - 300)
        return " ".join(filler[a:a + rng.randrange(300)] + own + filler[b:b + rng.randrange(300)])

    docs, want = [], set()
    for item, question, answer in rows:
        for changed in (1, 2, 3):
            own = question + answer
            for i in rng.sample(range(len(own)), changed):
                own[i] = f"changed{i}"
            want.add((len(docs), item))
            docs.append((len(docs), around(own)))
        if len(question) >= 5:
            want.add((len(docs), item))
            docs.append((len(docs), around(question)))
        mixed = question + answer
        rng.shuffle(mixed)
        docs.append((len(docs), around(mixed)))
    got = decontaminate.contaminated(spark.createDataFrame(docs, "doc_id long, text string"), items)
    assert {(r.doc_id, r.item_id) for r in got.collect()} == want


def test_every_half_covered_segment_reaches_the_threshold():
    import numpy as np

    rng = random.Random(4)
    for _ in range(200):
        weights = np.array([rng.random() for _ in range(rng.randrange(1, 12))])
        n, k = len(weights), min(3, len(weights))
        need, least = -(-n // 2), 10.0 * n
        for bits in range(1 << n):
            runs = [r for r in f"{bits:0{n}b}".split("0") if r]
            if bits.bit_count() >= need and all(len(r) >= k for r in runs):
                least = min(least, sum(w for i, w in enumerate(weights.tolist()) if bits >> (n - 1 - i) & 1))
        assert abs(decontaminate.least_score(weights, k, need) - least) < 1e-9
