"""Near duplicates by a chosen-path set similarity join.

A text's set holds its distinct shingles of five words. Texts with equal sets are
one document from the start. For the others, `TREES` independent trees branch: the
root of a tree picks `BRANCHES` of a text's minwise shingles, and each value is a
node; texts that meet in a node are candidates. Small nodes are compared
exhaustively by signatures, of which a byte per minwise shingle is kept; of large ones, those that one class of linked texts
fills compare the few others with everything, and the rest branch again by further
minwise shingles. All that signatures let pass is confirmed on full sets.

Pairs that are linked already, through others, need no confirmation: the result is
the classes, and a class is complete when no unconfirmed candidate leads out of it.
So the first step of a level confirms one link per text only, the likeliest: within a
small node, or with a few pivots of a large one, which is linear however large a group
of copies is. The second step confirms pairs of different classes in mixed nodes alone,
where the texts' full sets meet.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark.llm.tables import removed, stored
from tidemark.llm.words import mix, shingles_of, words_of
from tidemark.llm.workers import importable
from tidemark.sources.shared import new_folder, use_checkpoints

WORDS = 5
#: Minwise shingles per text. At similarity 0.85 the share of equal ones deviates by 0.03.
SIGNATURE = 128
TREES, BRANCHES = 4, 2
#: A node of at most so many texts is compared exhaustively; larger nodes are split
#: into blocks of as many, or branch.
SMALL = 2048
#: Pivots of a larger node, about so many, are compared with all of it.
PIVOTS = 16
#: Levels of branching. Nodes that are large and mixed after the last are compared block by block.
DEPTH = 6
#: Standard deviations below the threshold at which a signature still passes a pair.
SLACK = 4.75
#: Candidate ids up to so many (of 8 bytes) are sent to every task that reads texts; more are joined by shuffle.
BROADCAST_IDS = 4_000_000
#: Links per task while classes are formed, and tasks at least.
LINKS_PER_TASK, MIN_TASKS = 200_000, 6

#: Minwise shingles that the trees' roots pick.
ROOTS = np.random.default_rng(7).permutation(SIGNATURE)[:TREES * BRANCHES]

_A = mix(np.arange(1, SIGNATURE + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)
_B = mix(np.arange(1001, SIGNATURE + 1001, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """(rows, SIGNATURE) least hashes per set; a row of an empty set is zero."""
    out = np.zeros((len(sets), SIGNATURE), np.uint32)
    full = [i for i, s in enumerate(sets) if len(s)]
    if full:
        joined = np.concatenate([sets[i] for i in full])
        starts = np.concatenate(([0], np.cumsum([len(sets[i]) for i in full])[:-1]))
        for j in range(SIGNATURE):
            values = (((joined ^ _B[j]) * _A[j]) >> np.uint64(32)).astype(np.uint32)
            out[full, j] = np.minimum.reduceat(values, starts)
    return out


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids = batch.column(0)
        for words in words_of(batch.column(1)):
            sets = shingles_of(words, WORDS)
            signs = signatures(sets)
            roots = signs[:, ROOTS].astype(np.int64)
            offsets = np.arange(len(sets) + 1, dtype=np.int32) * len(ROOTS)
            keys = [b"".join(int(x.sum(dtype=np.uint64)).to_bytes(8, "big") for x in (s, mix(s))) for s in sets]
            yield pa.RecordBatch.from_arrays([
                ids.slice(words.first_row, words.rows), pa.array([len(s) for s in sets], pa.int64()),
                pa.array(keys, pa.binary()), pa.array([r.tobytes() for r in signs.astype(np.uint8)], pa.binary()),
                pa.ListArray.from_arrays(pa.array(offsets), pa.array(roots.ravel()))],
                names=["doc_id", "n_shingles", "set_key", "signature", "roots"])


def _full_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids = batch.column(0)
        for words in words_of(batch.column(1)):
            sets = shingles_of(words, WORDS)
            offsets = np.concatenate(([0], np.cumsum([len(s) for s in sets]))).astype(np.int32)
            flat = np.concatenate(sets).view(np.int64) if sets else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [ids.slice(words.first_row, words.rows), pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))], names=["doc_id", "shingles"])


def sketches(docs: DataFrame, folder: str) -> DataFrame:
    """(doc_id, n_shingles, set_key, signature, roots) of every row, written to `folder`:
    the least byte of each minwise shingle, and all of those that roots pick."""
    made = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        _sketch, "doc_id long, n_shingles long, set_key binary, signature binary, roots array<long>")
    return stored(made, folder)


def _minwise(position: Column) -> Column:
    """The kept byte of the minwise shingle at a position from 0."""
    return F.substring(F.col("signature"), position + 1, F.lit(1))


def _roots(texts: DataFrame) -> DataFrame:
    """(node, doc_id): each tree's root picks its own positions."""
    nodes = F.array(*[F.xxhash64(F.lit(f"tree {i // BRANCHES} by {p}"), F.col("roots")[i]) for i, p in enumerate(ROOTS.tolist())])
    return texts.select("doc_id", F.explode(nodes).alias("node"))


def _children(members: DataFrame, texts: DataFrame) -> DataFrame:
    """(node, doc_id) one level down: a node picks positions by its own hash."""
    with_sign = members.join(texts.select("doc_id", "signature"), "doc_id")
    places = [F.pmod(F.xxhash64("node", F.lit(j)), F.lit(SIGNATURE)).cast("int") for j in range(BRANCHES)]
    nodes = F.array(*[F.xxhash64("node", p, _minwise(p)) for p in places])
    return with_sign.select("doc_id", F.explode(F.array_distinct(nodes)).alias("node"))


def _shared(members: DataFrame) -> DataFrame:
    """Node statistics of nodes that hold more than one text."""
    return members.groupBy("node").agg(F.count("*").alias("size")).filter("size > 1")


def passing(percent: int) -> int:
    """Equal bytes of minwise shingles that a pair must have to be confirmed on full sets.
    Shingles that differ share their byte once in 256, so that a pair at the threshold has
    rather more than its share; the mark is that of equal shingles."""
    p = percent / 100
    return max(1, int(SIGNATURE * (p - SLACK * (p * (1 - p) / SIGNATURE) ** 0.5)))


def _nodes(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Table, list[tuple[int, int]]]]:
    """(rows, bounds of the nodes' parts) of rows that come sorted by (node, part); a
    part's rows stay together."""
    held: list[pa.RecordBatch] = []

    def whole() -> tuple[pa.Table, list[tuple[int, int]]]:
        table = pa.Table.from_batches(held)
        held.clear()
        node, part = table.column("node").to_numpy(), table.column("part").to_numpy()
        cut = (np.flatnonzero((node[1:] != node[:-1]) | (part[1:] != part[:-1])) + 1).tolist()
        return table, [(a, b) for a, b in zip([0, *cut], [*cut, len(node)]) if b - a > 1]

    for batch in batches:
        if not batch.num_rows:
            continue
        node, part = batch.column("node").to_numpy(), batch.column("part").to_numpy()
        if held and (held[-1].column("node")[-1].as_py() != node[0] or held[-1].column("part")[-1].as_py() != part[0]):
            yield whole()
        # the last part of a batch may go on in the next
        other = np.flatnonzero((node != node[-1]) | (part != part[-1]))
        cut = int(other[-1]) + 1 if len(other) else 0
        if cut:
            held.append(batch.slice(0, cut))
            yield whole()
        held.append(batch.slice(cut))
    if held:
        yield whole()


def _passing_pairs(table: pa.Table, bounds: list[tuple[int, int]], percent: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, places a and b, likeliest first) of each part's pairs of different
    labels that pass by size and signature; one of the two asks."""
    sign = np.frombuffer(b"".join(table.column("signature").to_pylist()), np.uint8).reshape(-1, SIGNATURE)
    sizes, labels, asking = (table.column(c).to_numpy() for c in ("n_shingles", "label", "asks"))
    least = passing(percent)
    for first, end in bounds:
        own, size, label, asks = sign[first:end], sizes[first:end], labels[first:end], asking[first:end]
        place = np.arange(end - first)
        found_a, found_b, found_n = [], [], []
        for q in np.flatnonzero(asks).tolist():
            others = np.flatnonzero((100 * np.minimum(size, size[q]) >= percent * np.maximum(size, size[q])) & (label != label[q]) & (~asks | (place > q)))
            if len(others):
                equal = (own[others] == own[q]).sum(axis=1)
                ok = equal >= least
                found_a.append(np.full(int(ok.sum()), q))
                found_b.append(others[ok])
                found_n.append(equal[ok])
        if found_a:
            order = np.argsort(-np.concatenate(found_n), kind="stable")
            yield first, np.concatenate(found_a)[order], np.concatenate(found_b)[order]


class _Sets:
    """Disjoint sets of any keys."""

    def __init__(self):
        self.parent: dict = {}

    def root(self, x):
        path = []
        while self.parent.get(x, x) != x:
            path.append(x)
            x = self.parent[x]
        for y in path:
            self.parent[y] = x
        return x

    def join(self, x, y) -> bool:
        x, y = self.root(x), self.root(y)
        if x != y:
            self.parent[x] = y
        return x != y


def _as_pairs(pairs: list[tuple[int, int]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([min(p) for p in pairs], pa.int64()), pa.array([max(p) for p in pairs], pa.int64())], names=["a", "b"])


def _likeliest(percent: int):
    """Pairs that would link each part's texts, the likeliest first: fewer than texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, bounds in _nodes(batches):
            ids, labels = table.column("doc_id").to_numpy(), table.column("label").to_numpy()
            pairs = []
            for first, a, b in _passing_pairs(table, bounds, percent):
                sets = _Sets()
                for x, y in zip((a + first).tolist(), (b + first).tolist()):
                    if sets.join(int(labels[x]), int(labels[y])):
                        pairs.append((int(ids[x]), int(ids[y])))
            yield _as_pairs(pairs)

    return run


def _involved(percent: int):
    """Texts of each part that are in a passing pair."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, bounds in _nodes(batches):
            rows = [np.zeros(0, np.int64)] + [np.unique(np.concatenate((a, b))) + first for first, a, b in _passing_pairs(table, bounds, percent)]
            yield pa.RecordBatch.from_arrays([table.column(c).take(pa.array(np.concatenate(rows))).combine_chunks() for c in ("node", "part", "doc_id")], names=["node", "part", "doc_id"])

    return run


def _links_in(percent: int):
    """Links of each part, confirmed on full sets, that join texts of different labels:
    a pair that others have joined is not looked at."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, bounds in _nodes(batches):
            ids, labels = table.column("doc_id").to_numpy(), table.column("label").to_numpy()
            full = table.column("shingles").combine_chunks()
            offsets, flat = full.offsets.to_numpy(), full.values.to_numpy().view(np.uint64)
            pairs = []
            for first, a, b in _passing_pairs(table, bounds, percent):
                sets = _Sets()
                for x, y in zip((a + first).tolist(), (b + first).tolist()):
                    if sets.root(int(labels[x])) == sets.root(int(labels[y])):
                        continue
                    one, two = flat[offsets[x]:offsets[x + 1]], flat[offsets[y]:offsets[y + 1]]
                    place = np.searchsorted(two, one)
                    place[place == len(two)] = 0
                    common = int((two[place] == one).sum())
                    if 100 * common >= percent * (len(one) + len(two) - common):
                        sets.join(int(labels[x]), int(labels[y]))
                        pairs.append((int(ids[x]), int(ids[y])))
            yield _as_pairs(pairs)

    return run


def _by_part(members: DataFrame, texts: DataFrame) -> DataFrame:
    return members.join(texts.select("doc_id", "n_shingles", "signature"), "doc_id").repartition("node", "part").sortWithinPartitions("node", "part", "doc_id")


def _sets_of(docs: DataFrame, ids: DataFrame, folder: str) -> DataFrame:
    """(doc_id, shingles) of some documents, made anew from their texts."""
    n = ids.count()
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    chosen = rows.join(F.broadcast(ids) if n <= BROADCAST_IDS else ids, "doc_id", "left_semi")
    sets = stored(chosen.mapInArrow(_full_sets, "doc_id long, shingles array<long>"), folder)
    return sets if sets.count() <= n else sets.dropDuplicates()


def _settled(docs: DataFrame, members: DataFrame, texts: DataFrame, percent: int, folder: str) -> DataFrame:
    """Links between texts of different labels within the parts of `members`. The full
    sets of texts in passing pairs travel to the parts, not the pairs to the sets: a group
    of texts that are almost similar enough has many more pairs than texts."""
    members = stored(members, f"{folder}/members")
    involved = stored(_by_part(members, texts).mapInArrow(_involved(percent), "node long, part int, doc_id long"), f"{folder}/involved")
    if involved.isEmpty():
        return involved.select(F.col("doc_id").alias("a"), F.col("doc_id").alias("b"))
    sets = _sets_of(docs, stored(involved.select("doc_id").distinct(), f"{folder}/ids"), f"{folder}/sets")
    asked = _by_part(members.join(involved, ["node", "part", "doc_id"], "left_semi").join(sets, "doc_id"), texts)
    links = stored(asked.mapInArrow(_links_in(percent), "a long, b long").distinct(), f"{folder}/links")
    removed(docs.sparkSession, *[f"{folder}/{name}" for name in ("members", "involved", "ids", "sets")])
    return links


def _pivoted(large: DataFrame) -> DataFrame:
    """Members of large nodes (node, doc_id, size) in blocks, each with all pivots."""
    blocks = F.ceil(F.col("size") / (SMALL / 2)).cast("int")
    pivot = F.pmod(F.xxhash64("node", "doc_id"), F.greatest(F.floor(F.col("size") / PIVOTS), F.lit(1))) == 0
    own = F.pmod(F.xxhash64("doc_id"), blocks).cast("int")
    parts = F.when(pivot, F.sequence(F.lit(0), blocks - 1)).otherwise(F.array(own))
    return large.select("node", F.explode(parts).alias("part"), "doc_id", pivot.alias("asks"))


def _confirmed(docs: DataFrame, pairs: DataFrame, percent: int, folder: str) -> DataFrame:
    """Pairs (a, b) whose full sets are similar enough. The sets are made anew from the
    texts of the pairs' documents alone."""
    pairs = stored(pairs.distinct(), f"{folder}/pairs")
    if pairs.isEmpty():
        return pairs
    sets = _sets_of(docs, stored(pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct(), f"{folder}/ids"), f"{folder}/sets")
    left = sets.select(F.col("doc_id").alias("a"), F.col("shingles").alias("set_a"))
    right = sets.select(F.col("doc_id").alias("b"), F.col("shingles").alias("set_b"))
    both = pairs.join(right, "b").join(left, "a")
    common = F.size(F.array_intersect("set_a", "set_b"))
    linked = both.select("a", "b", common.alias("common"), (F.size("set_a") + F.size("set_b")).alias("total")).filter(
        100 * F.col("common") >= percent * (F.col("total") - F.col("common"))).select("a", "b")
    links = stored(linked, f"{folder}/links")
    removed(docs.sparkSession, *[f"{folder}/{name}" for name in ("pairs", "ids", "sets")])
    return links


def classes(links: DataFrame) -> DataFrame:
    """(doc_id, label): the least id reachable over the links (a, b), of every id
    that has one. Alternates: larger neighbours go to the least one around a text,
    then all smaller ones do, until nothing changes."""
    use_checkpoints(links.sparkSession)
    links = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u <> v").distinct().checkpoint()
    before, width = None, max(MIN_TASKS, links.count() // LINKS_PER_TASK)
    while True:
        both = links.union(links.select("v", "u"))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).coalesce(width)
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        ends = F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))
        links = large.join(least, "u").coalesce(width).select(F.explode(ends).alias("e")).select("e.*").filter("u <> v").distinct().coalesce(width).checkpoint()
        now = links.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            return links.select(F.col("u").alias("doc_id"), F.col("v").alias("label"))
        before = now


def _labelled(members: DataFrame, labels: DataFrame | None) -> DataFrame:
    if labels is None:
        return members.withColumn("label", F.col("doc_id"))
    return members.join(labels, "doc_id", "left").withColumn("label", F.coalesce("label", "doc_id"))


def linked_classes(docs: DataFrame, percent: int = 80) -> DataFrame:
    """One row per row of `docs` (doc_id, text): doc_id, n_shingles, component_id
    (the least doc_id reachable over links), kept (whether it is that one).

    Two rows are linked when their sets' intersection is at least `percent` of the
    union. A null or empty text, or one without words, has an empty set and no link.
    Rows that repeat a doc_id are one document, linked by any of its rows' sets; each
    row is returned. Rows without a doc_id have no link, a null component_id, and
    are kept. Other columns are not read.
    """
    spark: SparkSession = docs.sparkSession
    importable(spark)
    folder = new_folder(spark, "near-dups")
    use_checkpoints(spark)
    every = sketches(docs, f"{folder}/sketches")
    usable = every.filter("doc_id is not null and n_shingles > 0")
    # Equal sets: one document stands for all.
    texts = stored(usable.groupBy("set_key", "signature", "roots", "n_shingles").agg(F.min("doc_id").alias("doc_id"), F.count("*").alias("copies")), f"{folder}/texts")
    stands = texts.filter("copies > 1").select("set_key", F.col("doc_id").alias("a"))
    links = [usable.select("set_key", F.col("doc_id").alias("b")).join(stands, "set_key").select("a", "b").filter("a <> b")]

    members = _roots(texts)
    texts = texts.drop("roots", "set_key", "copies")
    found: list[DataFrame] = []
    labels, depth = None, 0
    while True:
        members = stored(members.join(_shared(members), "node"), f"{folder}/members-{depth}")
        small = members.filter(F.col("size") <= SMALL).select("node", F.lit(0).alias("part"), "doc_id", F.lit(True).alias("asks"))
        large = members.filter(F.col("size") > SMALL)
        fresh = _by_part(_labelled(small.union(_pivoted(large)), labels), texts).mapInArrow(_likeliest(percent), "a long, b long")
        found.append(_confirmed(docs, fresh, percent, f"{folder}/confirmed-{depth}"))
        labels = stored(classes(reduce(DataFrame.union, found)), f"{folder}/labels-{depth}")
        # What is not settled: nodes whose texts have more than one label.
        tagged = _labelled(members, labels)
        per_label = tagged.groupBy("node", "label").agg(F.count("*").alias("n"))
        main = per_label.groupBy("node").agg(F.max(F.struct("n", "label")).alias("m"), F.sum("n").alias("all")).select(
            "node", F.col("m.label").alias("main"), (F.col("all") - F.col("m.n")).alias("outside")).filter("outside > 0")
        # two texts have been compared already
        mixed = stored(tagged.filter("size > 2").join(main, "node"), f"{folder}/mixed-{depth}")
        branching = (F.col("size") > SMALL) & (F.col("outside") > SMALL) & F.lit(depth < DEPTH)
        found.append(_settled(docs, _blocks(mixed.filter(~branching)), texts, percent, f"{folder}/settled-{depth}"))
        deeper = mixed.filter(branching)
        depth += 1
        if deeper.isEmpty():
            break
        members = _children(deeper.select("node", "doc_id"), texts)
        removed(spark, f"{folder}/members-{depth - 1}")
    labels = classes(reduce(DataFrame.union, [*found, *links]))
    return every.select("doc_id", "n_shingles").join(labels, "doc_id", "left").select(
        "doc_id", "n_shingles", F.coalesce("label", "doc_id").alias("component_id"),
        F.coalesce(F.col("doc_id") == F.coalesce("label", "doc_id"), F.lit(True)).alias("kept"))


def _blocks(mixed: DataFrame) -> DataFrame:
    """Members (node, part, doc_id, label, asks) of mixed nodes (node, doc_id, size, label,
    main, outside): texts outside the main class ask all others, in blocks of about SMALL
    texts. A block of askers meets a block of texts in one part."""
    width = SMALL
    n = F.ceil(F.col("size") / width).cast("int")
    asked = F.when(F.col("label") == F.col("main"), F.lit(False)).otherwise(F.lit(True)).alias("asks")
    ask_blocks = F.ceil(F.col("outside") / width).cast("int")
    one = mixed.filter(n <= 1).select("node", F.lit(0).alias("part"), "doc_id", "label", asked)
    many = mixed.filter(n > 1).withColumn("n", n).withColumn("q", ask_blocks)
    own = F.pmod(F.xxhash64("doc_id"), F.col("n")).cast("int")
    ask = F.pmod(F.xxhash64("doc_id", F.lit(1)), F.col("q")).cast("int")
    # Texts of the main class in block i meet askers of block j in part i*q + j; askers meet each other in the parts after those.
    main = many.filter("label = main").select("node", F.explode(F.transform(F.sequence(F.lit(0), F.col("q") - 1), lambda j: own * F.col("q") + j)).alias("part"), "doc_id", "label", F.lit(False).alias("asks"))
    out = many.filter("label <> main")
    to_main = out.select("node", F.explode(F.transform(F.sequence(F.lit(0), F.col("n") - 1), lambda i: i * F.col("q") + ask)).alias("part"), "doc_id", "label", F.lit(True).alias("asks"))
    return one.union(main).union(to_main).union(_among(out, ask))


def _among(out: DataFrame, ask: Column) -> DataFrame:
    """Askers of a large node among themselves: block i meets block j in part (i, j), below zero."""
    pairs = F.transform(F.sequence(F.lit(0), F.col("q") - 1), lambda j: -1 - (F.least(ask, j) * F.col("q") + F.greatest(ask, j)))
    return out.select("node", F.explode(F.array_distinct(pairs)).alias("part"), "doc_id", "label", F.lit(True).alias("asks"))


def op2_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Classes of near duplicates of all documents, at 85 percent."""
    return linked_classes(spark.read.parquet(f"{sf_dir}/documents.parquet"), 85)
