"""Alignment of the tokens of two tokenizers by coalescing their byte intervals.

The tokens of A and B are sorted together by start; a group ends where a token starts at
the running maximum of all ends before it, so where tokens of both sides end. Within a
group, each A token is linked with the B tokens whose bytes it overlaps.

Both tokenizers cut a text before a space or line break that follows another character than
a space and precedes a printable one: no token reaches over that place, whatever stands around it (`safe_cuts` checks
the vocabularies for it). Groups end there too, so a worker tokenizes and aligns each
distinct segment between such places once, many in one array, and puts the texts together.
Vocabularies without such places are applied to whole texts.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import chain

import numpy as np
import public_tokenizers
import pyarrow as pa
import sentencepiece
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from tokenizers import Tokenizer

from tidemark.llm.tables import stored
from tidemark.llm.workers import importable
from tidemark.sources.shared import new_folder

#: Bytes of text handled at once; longer texts are handled piece by piece.
PIECE = 1 << 20
#: Segments a worker remembers, and bytes of the longest of them.
REMEMBERED, LONGEST = 150_000, 48
#: Id pairs whose counts are sent to every task; all others are joined by shuffle.
SENT_PAIRS = 2_000_000
#: A pair of ids is one number: the A id above so many bits of the B id.
B_BITS = 15

CUT = re.compile(rb"(?<=[^ ])(?=[ \n][!-~\xc3-\xdf])")


def byte_letters() -> dict[str, int]:
    """The letters that stand for bytes in byte-level vocabularies: printable ones for
    themselves, the others for the code points from 256 on in order."""
    printable = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    others = [b for b in range(256) if b not in set(printable)]
    return {**{chr(b): b for b in printable}, **{chr(256 + i): b for i, b in enumerate(others)}}


@dataclass(frozen=True)
class Vocabularies:
    """Contents of the two files, as they are sent to tasks."""

    byte_level: str
    pieces: bytes

    @staticmethod
    def read(a: str | None = None, b: str | None = None) -> Vocabularies:
        """From two paths the driver can open; the public files without them."""
        with open(a or public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as f, open(b or public_tokenizers.path("piece_bpe_32k.model"), "rb") as g:
            return Vocabularies(f.read(), g.read())


def coalesced(a_start: np.ndarray, a_end: np.ndarray, b_start: np.ndarray, b_end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Group numbers of A's and of B's tokens, given as byte intervals, each side in
    order of starts. Tokens of one group are connected by overlaps."""
    start, end = np.concatenate((a_start, b_start)), np.concatenate((a_end, b_end))
    order = np.lexsort((np.arange(len(start)), start))
    reach = np.maximum.accumulate(end[order]) if len(start) else end
    breaks = np.ones(len(start), bool)
    breaks[1:] = start[order][1:] >= reach[:-1]
    group = np.empty(len(start), np.int64)
    group[order] = np.cumsum(breaks) - 1
    return group[:len(a_start)], group[len(a_start):]


def overlaps(a_start: np.ndarray, a_end: np.ndarray, b_start: np.ndarray, b_end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places (i, j) of all A and B tokens that share a byte, by i and j."""
    first = np.searchsorted(b_end, a_start, "right")
    count = np.maximum(np.searchsorted(b_start, a_end, "left") - first, 0)
    i = np.repeat(np.arange(len(a_start)), count)
    offset = np.cumsum(count) - count
    return i, np.arange(len(i)) - np.repeat(offset - first, count)


#: What is known of a segment: A tokens, B tokens, groups, links, the groups' text, the
#: links' pairs as int32. BAD is a segment whose tokens do not give its bytes.
Aligned = tuple[int, int, int, int, bytes, bytes]
BAD: Aligned = (-1, 0, 0, 0, b"", b"")


@dataclass
class PairCoder:
    """Tokenizes and aligns segments, remembering those it has seen: the last REMEMBERED
    and as many before them."""

    files: Vocabularies
    known: dict[bytes, Aligned] = field(default_factory=dict)
    older: dict[bytes, Aligned] = field(default_factory=dict)

    def __post_init__(self):
        self.a = Tokenizer.from_str(self.files.byte_level)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_proto=self.files.pieces)
        letters = byte_letters()
        vocabulary = self.a.get_vocab(with_added_tokens=False)
        self.a_bytes = [b""] * (max(self.a.get_vocab(with_added_tokens=True).values()) + 1)
        for token, i in vocabulary.items():
            self.a_bytes[i] = bytes(letters[c] for c in token)
        self.pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else b"" if self.b.is_control(i) else p.replace("▁", " ").encode() for i, p in enumerate(self.pieces)]
        self.a_sizes = np.array([len(t) for t in self.a_bytes], np.int64)
        self.b_sizes = np.array([len(t) for t in self.b_bytes], np.int64)
        # "7," "7|" for ids that others of their side, or the other side, follow
        self.inner = [f"{i},".encode() for i in range(max(len(self.a_bytes), len(self.b_bytes)))]
        self.last_a = [f"{i}|".encode() for i in range(len(self.a_bytes))]
        self.last_b = [f"{i};".encode() for i in range(len(self.b_bytes))]
        if len(self.b_bytes) > 1 << B_BITS or len(self.a_bytes) > 1 << (31 - B_BITS):
            raise ValueError("a pair of ids has to fit in 31 bits")
        self.cuts = self.safe_cuts()

    def safe_cuts(self) -> bool:
        """Whether no token reaches over a place that CUT finds: A splits words as byte-level
        vocabularies do, changes no character, and B has no piece with a space inside, none
        with a line break, and puts a space of its own before a text."""
        spec = json.loads(self.files.byte_level)
        splitter = spec.get("pre_tokenizer") or {}
        whole = splitter.get("type") == "ByteLevel" and splitter.get("use_regex") is True and splitter.get("add_prefix_space") is False
        pieces = not any("▁" in p.lstrip("▁") or "\n" in p for p in self.pieces)
        return bool(whole and spec.get("normalizer") is None and pieces and self.b.encode("\n", out_type=str) == ["▁", "<0x0A>"])

    def segments(self, piece: bytes) -> list[bytes]:
        return CUT.split(piece) if self.cuts else [piece]

    def pieces_of(self, text: bytes) -> Iterator[bytes]:
        """The text with a space before it, in pieces of about PIECE bytes if it can be cut."""
        text = b" " + text
        at = 0
        while self.cuts and len(text) - at > PIECE:
            cut = CUT.search(text, at + PIECE)
            if cut is None:
                break
            yield text[at:cut.start()]
            at = cut.start()
        yield text[at:] if at else text

    def learn(self, segments: list[bytes]) -> list[Aligned]:
        """Aligns distinct segments, all in the same arrays."""
        texts = [s.decode() for s in segments]
        a_ids = [e.ids for e in self.a.encode_batch_fast(texts, add_special_tokens=False)]
        # B puts a space before its text, which stands for the segment's first one
        b_ids = self.b.encode([t[1:] if t[0] == " " else t for t in texts], num_threads=1)
        b_ids = [ids if s[0] == 32 else ids[1:] for s, ids in zip(segments, b_ids)]
        size = np.array(list(map(len, segments)))
        a_flat, a_row = _flat(a_ids)
        b_flat, b_row = _flat(b_ids)
        same = [np.array_equal(np.bincount(row, sizes[flat], len(size)), size) and b"".join(map(table.__getitem__, flat.tolist())) == b"".join(segments)
                for flat, row, sizes, table in ((a_flat, a_row, self.a_sizes, self.a_bytes), (b_flat, b_row, self.b_sizes, self.b_bytes))]
        if not all(same):
            good = [b"".join([self.a_bytes[i] for i in a]) == s and b"".join([self.b_bytes[i] for i in b]) == s for s, a, b in zip(segments, a_ids, b_ids)]
            rest = iter(self.learn([s for s, g in zip(segments, good) if g]) if any(good) else [])
            return [next(rest) if g else BAD for g in good]
        # Each segment's bytes follow those of the one before.
        a_end, b_end = np.cumsum(self.a_sizes[a_flat]), np.cumsum(self.b_sizes[b_flat])
        a_start, b_start = a_end - self.a_sizes[a_flat], b_end - self.b_sizes[b_flat]
        a_group, b_group = coalesced(a_start, a_end, b_start, b_end)
        i, j = overlaps(a_start, a_end, b_start, b_end)
        links = ((a_flat[i] << B_BITS) | b_flat[j]).astype(np.int32).tobytes()
        texts_of = self._group_texts(a_flat, b_flat, a_group, b_group)
        group_row = np.zeros(int(a_group[-1]) + 1, np.int64)
        group_row[a_group] = a_row
        a_at, b_at, g_at, l_at = (np.searchsorted(rows, np.arange(len(segments) + 1)) for rows in (a_row, b_row, group_row, a_row[i]))
        sizes = [np.diff(at).tolist() for at in (a_at, b_at, g_at, l_at)]
        t_at, l_at = (a_at + b_at).tolist(), (4 * l_at).tolist()
        groups = [b"".join(texts_of[x:y])[:-1] for x, y in zip(t_at, t_at[1:])]
        return list(zip(*sizes, groups, [links[x:y] for x, y in zip(l_at, l_at[1:])]))

    def _group_texts(self, a: np.ndarray, b: np.ndarray, a_group: np.ndarray, b_group: np.ndarray) -> list[bytes]:
        """Per token, group by group and A before B, its id and what follows it."""
        a_last = np.append(a_group[1:] != a_group[:-1], True)
        b_last = np.append(b_group[1:] != b_group[:-1], True)
        a_text = [self.last_a[t] if last else self.inner[t] for t, last in zip(a.tolist(), a_last.tolist())]
        b_text = [self.last_b[t] if last else self.inner[t] for t, last in zip(b.tolist(), b_last.tolist())]
        both = a_text + b_text
        order = np.argsort(np.concatenate((a_group * 2, b_group * 2 + 1)), kind="stable")
        return [both[k] for k in order.tolist()]

    def of(self, segments: list[bytes]) -> list[Aligned]:
        """What is known of each segment, after learning the new ones."""
        found = list(map(self.known.get, segments))
        new = {s for s, f in zip(segments, found) if f is None}
        if not new:
            return found
        fresh = {s: self.older[s] for s in new if s in self.older}
        unseen = [s for s in new if s not in fresh]
        fresh.update(zip(unseen, self.learn(unseen) if unseen else ()))
        if len(self.known) + len(fresh) > REMEMBERED:
            self.known, self.older = {}, self.known
        self.known.update((s, x) for s, x in fresh.items() if len(s) <= LONGEST)
        return [fresh[s] if f is None else f for s, f in zip(segments, found)]


def _flat(ids: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    sizes = np.array(list(map(len, ids)))
    return np.fromiter(chain.from_iterable(ids), np.int64, int(sizes.sum())), np.repeat(np.arange(len(ids)), sizes)


class _Text:
    """A text's result, put together piece by piece."""

    def __init__(self):
        self.good, self.counts, self.sha, self.begun = True, [0] * 4, hashlib.sha256(), False
        self.pairs, self.times = np.zeros(0, np.int32), np.zeros(0, np.int64)

    def add(self, known: list[Aligned]) -> None:
        if not self.good or BAD in known:
            self.good = False
            return
        *counts, groups, links = zip(*known)
        self.counts = [n + sum(c) for n, c in zip(self.counts, counts)]
        self.sha.update((b";" if self.begun else b"") + b";".join(groups))
        self.begun = True
        links = np.sort(np.frombuffer(b"".join(links), np.int32))
        first = np.flatnonzero(np.append(True, links[1:] != links[:-1]))
        pairs, times = links[first], np.diff(np.append(first, len(links)))
        if len(self.pairs):
            merged, place = np.unique(np.concatenate((self.pairs, pairs)), return_inverse=True)
            times = np.bincount(place, np.concatenate((self.times, times)), len(merged)).astype(np.int64)
            pairs = merged
        self.pairs, self.times = pairs, times

    def result(self) -> tuple:
        if not self.good or not self.begun:
            return 0, 0, 0, 0, "", np.zeros(0, np.int32), np.zeros(0, np.int64)
        return (*self.counts, self.sha.hexdigest(), self.pairs, self.times)


_coders: dict[str, PairCoder] = {}


def _coder(files: Vocabularies, key: str) -> PairCoder:
    """This worker's coder of the files: tasks that follow each other share it."""
    if key not in _coders:
        _coders.clear()
        _coders[key] = PairCoder(files)
    return _coders[key]


def texts_aligned(coder: PairCoder, texts: list[bytes | None]) -> list[tuple]:
    """(n_a, n_b, n_groups, n_links, groups_sha256, distinct pairs, times of each) per text."""
    rows = [_Text() for _ in texts]
    held: list[tuple[int, list[bytes]]] = []
    size = 0

    def settle() -> None:
        known = coder.of([s for _, segments in held for s in segments])
        at = 0
        for r, segments in held:
            rows[r].add(known[at:at + len(segments)])
            at += len(segments)
        held.clear()

    for r, text in enumerate(texts):
        for piece in coder.pieces_of(text) if text else ():
            held.append((r, coder.segments(piece)))
            size += len(piece)
            if size >= PIECE:
                settle()
                size = 0
    settle()
    return [row.result() for row in rows]


ALIGNED = "row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pairs array<int>, times array<long>"


def _lists(values: list[np.ndarray], dtype) -> pa.ListArray:
    offsets = np.concatenate(([0], np.cumsum([len(v) for v in values]))).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(values).astype(dtype) if values else np.zeros(0, dtype)))


def aligned(docs: DataFrame, files: Vocabularies) -> DataFrame:
    """(row, doc_id, n_a, n_b, n_groups, n_links, groups_sha256, pairs, times) per row of
    `docs` (doc_id, text): the distinct id pairs of its links and how often each occurs."""
    spark: SparkSession = docs.sparkSession
    importable(spark)
    key = hashlib.sha256(files.byte_level.encode() + files.pieces).hexdigest()
    sent = spark.sparkContext.broadcast(files)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _coder(sent.value, key)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                found = texts_aligned(coder, part.column(2).to_pylist())
                n_a, n_b, n_groups, n_links, sha, pairs, times = zip(*found)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), *[pa.array(x, pa.int64()) for x in (n_a, n_b, n_groups, n_links)], pa.array(sha, pa.string()),
                     _lists(pairs, np.int32), _lists(times, np.int64)],
                    names=["row", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pairs", "times"])

    ready = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long"), F.col("text").cast("string").cast("binary"))
    return ready.mapInArrow(run, ALIGNED)


def pair_counts(texts: DataFrame, folder: str) -> DataFrame:
    """(pair, n, best): documents that hold each pair linked, and whether no pair of the
    same A id has more. `texts` has distinct `pairs` per document."""
    counts = stored(texts.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count("*").alias("n")), f"{folder}/counts")
    # at most one row per id of A's vocabulary
    most = counts.groupBy(F.shiftright("pair", B_BITS).alias("a")).agg(F.max("n").alias("most"))
    held = counts.join(F.broadcast(most), F.shiftright("pair", B_BITS) == F.col("a"))
    return stored(held.select("pair", "n", (F.col("n") == F.col("most")).alias("best")), f"{folder}/best")


def _frequent(counts: DataFrame, limit: int) -> Column | None:
    """The condition of the pairs of most documents, `limit` at most; None if all are."""
    sizes = {r.b: r.c for r in counts.groupBy(F.floor(F.log2("n")).cast("int").alias("b")).agg(F.count("*").alias("c")).collect()}
    if sum(sizes.values()) <= limit:
        return None
    total, least = 0, max(sizes) + 1
    while total + sizes.get(least - 1, 0) <= limit:
        least -= 1
        total += sizes.get(least, 0)
    return F.floor(F.log2("n")).cast("int") >= least


def alignments(docs: DataFrame, files: Vocabularies | None = None, sent_pairs: int = SENT_PAIRS) -> DataFrame:
    """One row per row of `docs` (doc_id, text): doc_id, n_a, n_b, n_groups, n_links,
    n_best, count_sum, groups_sha256.

    A reads a space and the text, B the text, before which it puts a space itself. Groups
    are written `a1,a2|b1;a3|b2,b3`. A link's count is the number of rows that hold its two
    ids linked; n_best counts links of the highest count of their A id, ties included, and
    count_sum adds up the counts of all links.

    A null or empty text, and one whose tokens' bytes are not its own, has zeros and an
    empty groups_sha256. Rows that repeat an id or a text each count. Texts of any length
    are handled in pieces of PIECE bytes; what is kept of one is its distinct pairs. Other
    columns are not read; an empty table gives an empty one.
    """
    spark: SparkSession = docs.sparkSession
    folder = new_folder(spark, "alignment")
    texts = stored(aligned(docs, files or Vocabularies.read()), f"{folder}/texts")
    counts = pair_counts(texts, folder)
    # Frequent pairs, which make up nearly all links, go to every task, up to a fixed number.
    # Rows of the others meet their counts by shuffle: none of those pairs is a hot key.
    chosen = _frequent(counts, sent_pairs)
    table = (counts if chosen is None else counts.filter(chosen)).orderBy("pair").toArrow()
    sent = spark.sparkContext.broadcast(tuple(table.column(c).to_numpy() for c in ("pair", "n", "best")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair, n, best = sent.value
        for batch in batches:
            lists, times = batch.column(7), batch.column(8).flatten().to_numpy()
            pairs, sizes = lists.flatten().to_numpy(), lists.value_lengths().to_numpy()
            row = np.repeat(np.arange(batch.num_rows), sizes)
            place = np.minimum(np.searchsorted(pair, pairs), max(len(pair) - 1, 0))
            here = pair[place] == pairs if len(pair) else np.zeros(len(pairs), bool)
            at = place[here]
            count_sum, n_best = np.zeros(batch.num_rows, np.int64), np.zeros(batch.num_rows, np.int64)
            np.add.at(count_sum, row[here], n[at] * times[here])
            np.add.at(n_best, row[here], best[at] * times[here])
            rest = np.concatenate(([0], np.cumsum(np.bincount(row[~here], minlength=batch.num_rows)))).astype(np.int32)
            rare = [pa.ListArray.from_arrays(pa.array(rest), pa.array(x[~here])) for x in (pairs, times)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:7], pa.array(n_best), pa.array(count_sum), *rare],
                                             names=[*batch.schema.names[:7], "n_best", "count_sum", "pairs", "times"])

    scored = texts.mapInArrow(run, ALIGNED.replace("pairs", "n_best long, count_sum long, pairs"))
    own = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    if chosen is None:
        return scored.select(*own)
    scored = stored(scored, f"{folder}/scored")
    rare = scored.select("row", F.explode(F.arrays_zip("pairs", "times")).alias("l")).select("row", "l.pairs", "l.times")
    met = rare.join(counts.filter(~chosen), F.col("pairs") == F.col("pair"))
    more = met.groupBy("row").agg(F.sum(F.col("n") * F.col("times")).alias("more_sum"), F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("more_best"))
    whole = scored.join(more, "row", "left")
    return whole.withColumn("n_best", F.col("n_best") + F.coalesce("more_best", F.lit(0))).withColumn(
        "count_sum", F.col("count_sum") + F.coalesce("more_sum", F.lit(0))).select(*own)


def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of byte_bpe_50k and piece_bpe_32k aligned in all documents."""
    return alignments(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
