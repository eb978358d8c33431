"""Benchmark decontamination: training passages query an index of test items.

Test items, and their questions alone, are cut into segments of at most `SEGMENT` words,
which form a BM25 inverted index. Every training text is cut into overlapping passages,
twice as long, so that a segment that occurs lies whole in one of them. A passage covers
the words of a segment that stand in runs of `SHINGLE` words of both. Impacts are shares
of the least score of a passage that covers half of a segment, so each passage is a
query: block-max WAND retrieves all segments whose score reaches one, and none that is
half covered is lost. For the items found, the words covered are counted.

Passages without a run of the index are no queries. For the others, the sums of the
blocks' greatest impacts are formed for many passages at once, as rows of a table of
terms and blocks; only blocks that reach the threshold are searched. A block holds
neighbouring segments.

Items are bounded by passes: each pass takes items of some megabytes, whose index is
sent to every task, and reads the texts once. Nothing is shuffled.
"""

from __future__ import annotations

import math
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark.llm.tables import stored
from tidemark.llm.words import Words, mix, words_of, _STEPS
from tidemark.llm.workers import importable
from tidemark.sources.shared import new_folder

SEGMENT = 64
#: Share of the words of an item, or of its question, that a contaminated text covers, and
#: words covered at least, or all where there are fewer.
OVERLAP, LEAST_WORDS = 0.5, 8
#: Words of a question that counts without its answer.
QUESTION_WORDS = 5
SHINGLE = 3
K1, B = 1.2, 0.75
#: Segments per block of the index, and segments of one index at most.
BLOCK, SEGMENTS = 2, 512
#: Pairs of passage and term whose blocks are summed at once.
PAIRS = 1 << 13
#: Bytes of items whose index is sent to the tasks at once.
PASS_BYTES = 4_000_000
#: What sums of 4-byte floats may be too low by.
ROUNDING = 1e-4


def question_of(text: Column) -> Column:
    """All sentences but the last; the whole text where there is one only."""
    head = F.regexp_extract(text, r"(?s)^(.*\S)\s*(?<=[.!?])\s+\S[^.!?]*[.!?]*\s*$", 1)
    return F.when(head == "", text).otherwise(head)


def answer_of(text: Column) -> Column:
    """The last sentence of several, else empty."""
    return F.regexp_extract(text, r"(?s)^.*\S\s*(?<=[.!?])\s+(\S[^.!?]*[.!?]*)\s*$", 1)


def _terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = {}
        for name in ("question", "answer"):
            lists: list[list[int]] = []
            for w in words_of(batch.column(name), alnum=True):
                signed = w.hash.view(np.int64)
                lists += [signed[a:b].tolist() for a, b in zip(w.bounds[:-1], w.bounds[1:])]
            found[name] = pa.array(lists, pa.list_(pa.int64()))
        yield pa.RecordBatch.from_arrays([batch.column("item_id"), found["question"], found["answer"]], names=["item_id", "question", "answer"])


def run_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """Hashes of the runs of k words."""
    n = len(words) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for j in range(k):
        out += words[j:j + n] * _STEPS[j]
    return mix(out)


def least_score(weights: np.ndarray, k: int, need: int) -> float:
    """Least sum of `need` weights or more that stand in runs of k or more."""
    best = np.full((k + 1, need + 1), np.inf)  # by length of the run at the end (k for more) and number taken
    best[0, 0] = 0.0
    for x in weights.tolist():
        closed = np.minimum(best[0], best[k])
        longer = np.concatenate((closed[None], best[1:]))
        taken = np.full_like(longer, np.inf)
        taken[:, 1:] = longer[:, :-1] + x
        taken[:, need] = np.minimum(taken[:, need], longer[:, need] + x)
        best[0], best[1:] = closed, taken[:k]
        best[k] = np.minimum(best[k], taken[k])
    return float(min(best[0, need], best[k, need]))


def pieces_of(words: np.ndarray) -> list[np.ndarray]:
    return np.array_split(words, -(-len(words) // SEGMENT)) if len(words) else []


def searched(question: np.ndarray, answer: np.ndarray) -> list[np.ndarray]:
    """The segments of an item and those of its question alone."""
    alone = len(answer) > 0 and len(question) >= QUESTION_WORDS
    return pieces_of(np.concatenate([question, answer])) + (pieces_of(question) if alone else [])


def holds(covered: int, words: int) -> bool:
    return covered >= max(OVERLAP * words, min(words, LEAST_WORDS))


Runs = list[tuple[int, np.ndarray]]  # (length of runs, their hashes in order) of each segment


@dataclass
class Index:
    """Segments of some items: postings by term, and the items' runs of words."""

    terms: np.ndarray  # sorted hashes
    ids: list[list[int]]  # per term the segments, ascending
    impacts: list[list[float]]
    most: np.ndarray  # per term the greatest impact
    block_most: np.ndarray  # (terms, blocks), the greatest impact in a block
    item: np.ndarray  # of each segment
    least: np.ndarray  # of each segment, the score whose share impacts are
    items: list[int]
    runs: list[tuple[Runs, Runs, Runs]]  # per item of the whole, the question and the answer
    known: dict[int, np.ndarray]  # by length, the sorted hashes of all runs
    asked: set[int]  # lengths of the runs of whole items; a passage that is searched has one of these
    seen: np.ndarray  # bits of the terms' first bits

    @staticmethod
    def build(items: list[int], questions: list[np.ndarray], answers: list[np.ndarray], frequency: dict[int, int], n_items: int, mean_words: float) -> list["Index"]:
        """Indexes of at most SEGMENTS segments, or of one item."""
        pieces = [len(searched(q, a)) for q, a in zip(questions, answers)]
        out, first = [], 0
        while first < len(items):
            last, total = first + 1, pieces[first]
            while last < len(items) and total + pieces[last] <= SEGMENTS:
                total += pieces[last]
                last += 1
            out.append(Index._of(items[first:last], questions[first:last], answers[first:last], frequency, n_items, mean_words))
            first = last
        return out

    @staticmethod
    def _of(items: list[int], questions: list[np.ndarray], answers: list[np.ndarray], frequency: dict[int, int], n_items: int, mean_words: float) -> "Index":
        segments, item = [], []
        for i, (q, a) in enumerate(zip(questions, answers)):
            own = searched(q, a)
            segments += own
            item += [i] * len(own)
        mean = min(float(SEGMENT), mean_words)
        postings: dict[int, list[tuple[int, float]]] = {}
        scale = np.ones(len(segments))
        for s, words in enumerate(segments):
            values, place, counts = np.unique(words, return_inverse=True, return_counts=True)
            df = np.array([frequency[int(v)] for v in values], np.float64)
            idf = np.log1p((n_items - df + 0.5) / (df + 0.5))
            impact = idf * counts * (K1 + 1) / (counts + K1 * (1 - B + B * len(words) / mean))
            impact /= impact.sum()
            # a word that recurs is scored once, so each time counts for its part
            scale[s] = least_score((impact / counts)[place], min(SHINGLE, len(words)), math.ceil(OVERLAP * len(words)))
            for v, x in zip(values.tolist(), (impact / scale[s]).tolist()):
                postings.setdefault(v, []).append((s, x))
        terms = sorted(postings)
        impacts = [[x for _, x in postings[t]] for t in terms]
        blocks = np.zeros((len(terms), -(-len(segments) // BLOCK)), np.float32)
        for t, v in enumerate(terms):
            for s, x in postings[v]:
                blocks[t, s // BLOCK] = max(blocks[t, s // BLOCK], np.float32(x))
        seen = np.zeros(1 << 20, bool)
        hashes = np.array(terms, np.uint64)
        seen[(hashes >> np.uint64(44)).astype(np.int64)] = True

        def runs(words: np.ndarray) -> Runs:
            return [(min(SHINGLE, len(x)), run_hashes(x, min(SHINGLE, len(x)))) for x in pieces_of(words)]

        parts = [(runs(np.concatenate([q, a])), runs(q), runs(a)) for q, a in zip(questions, answers)]
        by_length: dict[int, list[np.ndarray]] = {}
        for k, own in (r for part in parts for runs_of in part for r in runs_of):
            by_length.setdefault(k, []).append(own)
        return Index(hashes, [[s for s, _ in postings[t]] for t in terms], impacts, np.array([max(x) for x in impacts], np.float64),
                     blocks, np.array(item, np.int64), scale, items, parts, {k: np.unique(np.concatenate(v)) for k, v in by_length.items()},
                     {k for whole, _, _ in parts for k, _ in whole}, seen)

    def retrieve(self, terms: list[int], least: float, live: list[int] | None = None) -> list[tuple[int, float]]:
        """(segment, score) of all segments whose score for the terms reaches
        `least`: block-max WAND, document at a time. `live` are the blocks that can
        reach it, ascending, where they are known; others are skipped."""
        ids, impacts, blocks = self.ids, self.impacts, self.block_most
        cursors = [[ids[t][0], 0, t, float(self.most[t])] for t in terms]
        out = []
        while True:
            cursors.sort()
            total, pivot = 0.0, -1
            for c, cur in enumerate(cursors):
                total += cur[3]
                if total >= least:
                    pivot = c
                    break
            if pivot < 0:
                return out
            at = cursors[pivot][0]
            while pivot + 1 < len(cursors) and cursors[pivot + 1][0] == at:
                pivot += 1
            # what the segment's block can give at most, over the terms up to the pivot
            block = at // BLOCK
            bound = sum(float(blocks[cur[2], block]) for cur in cursors[:pivot + 1])
            leave = (block + 1) * BLOCK
            if pivot + 1 < len(cursors):
                leave = min(leave, cursors[pivot + 1][0])
            if live is not None:
                following = bisect_left(live, block)
                if following == len(live):
                    return out
                if live[following] > block:
                    bound, leave = 0.0, live[following] * BLOCK
            if bound >= least - ROUNDING:
                score = 0.0
                for cur in cursors[:pivot + 1]:
                    own = ids[cur[2]]
                    place = bisect_left(own, at, cur[1])
                    if place < len(own) and own[place] == at:
                        score += impacts[cur[2]][place]
                if score >= least:
                    out.append((at, score))
                target = at + 1
            else:
                target = max(at + 1, leave)
            kept = cursors[pivot + 1:]
            for cur in cursors[:pivot + 1]:
                own = ids[cur[2]]
                place = bisect_left(own, target, cur[1])
                if place < len(own):
                    kept.append([own[place], place, cur[2], cur[3]])
            cursors = kept
            if not cursors:
                return out

    def shared(self, words: Words, first: np.ndarray) -> dict[int, tuple[np.ndarray, np.ndarray]]:
        """By length, (passages, hashes) of the runs that text and index share, by passage."""
        out = {}
        for k, own in self.known.items():
            found = run_hashes(words.hash, k)
            bits = np.zeros(1 << 20, bool)
            bits[(own >> np.uint64(44)).astype(np.int64)] = True
            at = np.flatnonzero(bits[(found >> np.uint64(44)).astype(np.int64)])
            place = np.searchsorted(own, found[at])
            place[place == len(own)] = 0
            row = words.row[at]
            at = at[(own[place] == found[at]) & (row == words.row[at + k - 1])]
            number, offset = np.divmod(at - words.bounds[words.row[at]], SEGMENT)
            passage = first[words.row[at]] + number
            # whole in the passage before, too
            earlier = (number > 0) & (offset + k <= SEGMENT)
            passage, hashes = np.concatenate((passage, passage[earlier] - 1)), np.concatenate((found[at], found[at][earlier]))
            order = np.argsort(passage, kind="stable")
            out[k] = passage[order], hashes[order]
        return out

    def matches(self, words: Words) -> Iterator[tuple[int, int, float, float, float]]:
        """(row, item, score, question overlap, answer overlap) of contaminated rows."""
        if not len(words.hash):
            return
        first = np.concatenate(([0], np.cumsum(np.diff(words.bounds) // SEGMENT + 1)))
        shared = self.shared(words, first)
        asks = np.zeros(first[-1] + 1, bool)
        for k in self.asked:
            asks[shared[k][0]] = True
        known = np.flatnonzero(self.seen[(words.hash >> np.uint64(44)).astype(np.int64)])
        row = words.row[known]
        number = (known - words.bounds[row]) // SEGMENT
        passage = first[row] + number
        # a passage spans two strides: a word is in its own stride's passage and in the one before
        own, earlier = asks[passage], (number > 0) & asks[passage - 1]
        passage, known = np.concatenate((passage[own], passage[earlier] - 1)), np.concatenate((known[own], known[earlier]))
        place = np.searchsorted(self.terms, words.hash[known])
        place[place == len(self.terms)] = 0
        hit = self.terms[place] == words.hash[known]
        if not hit.any():
            return
        key = np.unique(passage[hit] * len(self.terms) + place[hit])
        passage, term = key // len(self.terms), key % len(self.terms)
        starts = np.concatenate(([0], np.flatnonzero(passage[1:] != passage[:-1]) + 1, [len(passage)]))
        best: dict[tuple[int, int], float] = {}
        p = 0
        while p + 1 < len(starts):
            q = max(p + 1, int(np.searchsorted(starts, starts[p] + PAIRS, "right")) - 1)
            bound = np.add.reduceat(self.block_most[term[starts[p]:starts[q]]], starts[p:q] - starts[p], axis=0) >= 1 - ROUNDING
            for n in np.flatnonzero(bound.any(axis=1)).tolist():
                a, b = int(starts[p + n]), int(starts[p + n + 1])
                for segment, score in self.retrieve(term[a:b].tolist(), 1 - ROUNDING, np.flatnonzero(bound[n]).tolist()):
                    r = int(np.searchsorted(first, passage[a], "right")) - 1
                    pair = (r, int(self.item[segment]))
                    best[pair] = max(best.get(pair, 0.0), score * float(self.least[segment]))
            p = q

        def covered(r: int, segments: Runs) -> tuple[int, int]:
            """Words of the segments that the best passage of each covers, and all words."""
            total, out = 0, 0
            for k, own in segments:
                n, most = len(own) + k - 1, 0
                at, hashes = shared.get(k, (np.zeros(0, np.int64), np.zeros(0, np.uint64)))
                a, b = np.searchsorted(at, first[r:r + 2])
                mine = np.flatnonzero(np.isin(hashes[a:b], own)) + a
                for m in np.split(mine, np.flatnonzero(np.diff(at[mine])) + 1):
                    if k * len(m) > most:
                        begins = np.flatnonzero(np.isin(own, hashes[m]))
                        most = max(most, len(np.unique(begins[:, None] + np.arange(k))))
                total, out = total + n, out + most
            return out, total

        for (r, i), score in sorted(best.items()):
            whole, question, answer = self.runs[i]
            parts = covered(r, whole), covered(r, question)
            if holds(*parts[0]) or (parts[1][1] >= QUESTION_WORDS and holds(*parts[1])):
                shares = [c / n if n else 0.0 for c, n in (parts[1], covered(r, answer))]
                yield r, self.items[i], score, shares[0], shares[1]


def indexes(items: DataFrame, folder: str) -> Iterator[list[Index]]:
    """The indexes of (item_id, question, answer), by pass of about PASS_BYTES, whatever the
    ids are. Frequencies and the mean length are those of all items, and are counted
    once, in `folder`."""
    items = items.select(F.col("item_id").cast("long").alias("item_id"), *[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("question", "answer")])
    size = items.agg(F.sum(F.octet_length("question") + F.octet_length("answer"))).first()[0] or 0
    passes = -(-size // PASS_BYTES)
    termed = stored(items.mapInArrow(_terms, "item_id long, question array<long>, answer array<long>").withColumn(
        "words", F.concat("question", "answer")).filter(F.size("words") > 0), f"{folder}/terms")
    stats = termed.agg(F.count("*"), F.avg(F.size("words"))).first()
    if not stats[0]:
        return
    frequency = stored(termed.select(F.explode(F.array_distinct("words")).alias("term")).groupBy("term").agg(F.count("*").alias("df")), f"{folder}/frequency")
    for p in range(passes):
        mine = termed.filter(F.pmod(F.xxhash64("item_id", "question", "answer"), F.lit(passes)) == p)
        rows = mine.select("item_id", "question", "answer").collect()
        rows.sort(key=lambda r: (r.item_id is None, r.item_id or 0, r.question, r.answer))
        df = {t & 0xFFFFFFFFFFFFFFFF: n for t, n in frequency.join(mine.select(F.explode("words").alias("term")).distinct(), "term").collect()}
        unsigned = lambda x: np.array(x, np.int64).view(np.uint64)
        yield Index.build([r.item_id for r in rows], [unsigned(r.question) for r in rows], [unsigned(r.answer) for r in rows], df, stats[0], stats[1])


def contaminated(docs: DataFrame, items: DataFrame) -> DataFrame:
    """(doc_id, item_id, score, question_overlap, answer_overlap) of each pair of a row
    of (doc_id, text) and a test item (item_id, question, answer) it holds.

    Words are runs of letters and digits of any case. A text holds an item if its passages
    cover OVERLAP of the words of question and answer together, or of the question alone if
    it has QUESTION_WORDS; at least LEAST_WORDS, or all where there are fewer. Words are
    covered that stand in runs of SHINGLE words of both. Null and empty texts hold nothing, items without words are
    held by none, and without items the result is empty. Repeated rows and items give
    repeated pairs.
    """
    spark = docs.sparkSession
    importable(spark)
    schema = "doc_id long, item_id long, score double, question_overlap double, answer_overlap double"
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    folder = new_folder(spark, "decontamination")
    out = spark.createDataFrame([], schema)
    for number, own in enumerate(indexes(items, folder)):
        sent = spark.sparkContext.broadcast(own)

        def search(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                ids = batch.column(0)
                found = [(ids[w.first_row + m[0]].as_py(), *m[1:]) for w in words_of(batch.column(1), alnum=True) for index in sent.value for m in index.matches(w)]
                kinds = (pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.float64())
                yield pa.RecordBatch.from_arrays([pa.array([f[c] for f in found], k) for c, k in enumerate(kinds)], names=["doc_id", "item_id", "score", "question_overlap", "answer_overlap"])

        out = out.union(stored(rows.mapInArrow(search, schema), f"{folder}/matches-{number}"))
        sent.destroy()  # the driver and the tasks hold one pass's index at a time
    return out


def benchmark_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The items of the benchmark table, whose texts end with the answer."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", question_of(text).alias("question"), answer_of(text).alias("answer"))


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of documents and the test items they hold."""
    return contaminated(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"), benchmark_items(spark, sf_dir))
