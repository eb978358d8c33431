"""Spelling variants of the words of a corpus by a bidirectional FM-index.

Two words one error apart agree in one half: the error is behind a word's first half or
before its second. So a word meets, by that half, all words that begin (or end) with it;
the halves are hashed to parts of a fixed size, and each part is indexed on its own. Within a
part the search matches the exact half to the word's edge and extends across the other half
with one error. A half that very many words share is cut into blocks of its words, and the
words that ask for it go to every block.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.llm.fm_index import Vocabulary
from tidemark.llm.tables import stored
from tidemark.llm.workers import importable
from tidemark.sources.shared import new_folder

LEAST_LENGTH, LEAST_COUNT = 7, 2
#: How much more frequent a word's form is.
RATIO = 10
#: Rows of a part, and of a block of a half that more words share.
PART = 20_000
PARTS_PER_TASK = 4
#: Halves with blocks of their own that are sent to every task; more are joined by shuffle.
SENT_HALVES = 100_000

#: Fixed by the contract: a run of letters, and which occurrences lose a code point.
RUN, ONE_IN = f"[A-Za-zÀ-ÿ]{{{LEAST_LENGTH},}}", 31
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def vocabulary(docs: DataFrame) -> DataFrame:
    """(word, n) of `docs` (doc_id, text): maximal runs of Latin letters, A-Z in lower case.
    Where 31 divides the crc32 of `<doc_id>:<run>`, h, the run lost its code point at h modulo
    its length; a null doc_id is written as nothing. Words of LEAST_LENGTH code points and
    LEAST_COUNT occurrences or more."""
    runs = docs.select(F.coalesce(F.col("doc_id").cast("long").cast("string"), F.lit("")).alias("id"), F.explode(F.regexp_extract_all(F.col("text").cast("string"), F.lit(RUN), 0)).alias("run"))
    runs = runs.select("id", F.when(F.col("run").rlike("[A-Z]"), F.translate("run", UPPER, LOWER)).otherwise(F.col("run")).alias("run"))
    hashed = runs.select("run", F.crc32(F.concat("id", F.lit(":"), "run").cast("binary")).alias("h"))
    place = (F.col("h") % F.length("run")).cast("int")
    cut = F.concat(F.substring(F.col("run"), F.lit(1), place), F.substring(F.col("run"), place + 2, F.length("run")))
    words = hashed.select(F.when(F.col("h") % ONE_IN == 0, cut).otherwise(F.col("run")).alias("word")).filter(F.length("word") >= LEAST_LENGTH)
    return words.groupBy("word").agg(F.count("*").alias("n")).filter(F.col("n") >= LEAST_COUNT)


def _halves(words: DataFrame, right_exact: bool) -> DataFrame:
    """(key, word, n, asks): a word's own half, for which it asks, and the beginnings (or
    ends) by which words one code point longer or shorter ask for it."""
    n = F.length("word")
    first = F.floor(n / 2).cast("int")
    own = n - first if right_exact else first
    sizes = F.array_distinct(F.array(own, *[(F.ceil((n + d) / 2) if right_exact else F.floor((n + d) / 2)).cast("int") for d in (-1, 1)]))
    rows = words.select("word", "n", own.alias("own"), F.explode(sizes).alias("size"))
    half = F.substring(F.col("word"), F.length("word") - F.col("size") + 1, F.col("size")) if right_exact else F.substring(F.col("word"), F.lit(1), F.col("size"))
    return rows.select(F.xxhash64(F.lit(right_exact), half).alias("key"), "word", "n", (F.col("size") == F.col("own")).alias("asks"), F.lit(True).alias("listed"))


def _parts(rows: DataFrame, part_rows: int) -> tuple[DataFrame, int]:
    """The rows with a `part`, and how many parts there are about. A word that only asks in
    a block of a large half is not `listed` there."""
    sizes = rows.groupBy("key").agg(F.count("*").alias("rows"))
    total = sizes.agg(F.sum("rows").alias("n"), F.count(F.when(F.col("rows") > part_rows, 1)).alias("large")).first()
    n_parts = max(1, -(-(total.n or 0) // part_rows))
    cold = F.pmod("key", F.lit(n_parts))
    if not total.large:
        return rows.withColumn("part", cold), n_parts
    large = sizes.filter(F.col("rows") > part_rows).select(F.col("key").alias("large_key"), F.ceil(F.col("rows") / part_rows).cast("int").alias("blocks"))
    tagged = rows.join(F.broadcast(large) if total.large <= SENT_HALVES else large, F.col("key") == F.col("large_key"), "left")
    block = F.pmod(F.xxhash64("word"), F.col("blocks")).cast("int")
    blocks = F.when(F.col("blocks").isNull(), F.array(F.lit(-1))).when(F.col("asks"), F.sequence(F.lit(0), F.col("blocks") - 1)).otherwise(F.array(block))
    spread = tagged.select("key", "word", "n", "asks", block.alias("own_block"), F.explode(blocks).alias("b"))
    # parts of blocks are below zero
    part = F.when(F.col("b") < 0, cold).otherwise(F.xxhash64("key", "b").bitwiseOR(F.lit(-(1 << 63))))
    return spread.select("key", "word", "n", "asks", ((F.col("b") < 0) | (F.col("b") == F.col("own_block"))).alias("listed"), part.alias("part")), n_parts


def _search(right_exact: bool) -> Callable[[pa.Table], pa.Table]:
    """The words of a part that ask, with what they found there."""

    def run(table: pa.Table) -> pa.Table:
        key, asks, listed = (table.column(c).to_numpy() for c in ("key", "asks", "listed"))
        # a word alone under its half finds nothing
        _, place, count = np.unique(key, return_inverse=True, return_counts=True)
        met = count[place] > 1
        written = np.array([w.encode("latin-1") for w in table.column("word").to_pylist()], object)
        count = table.column("n").to_numpy()
        texts = dict(zip(written[met & listed].tolist(), count[met & listed].tolist()))
        words = sorted(texts)
        asking = sorted(set(written[met & asks].tolist()))
        sizes = np.array([len(w) // 2 for w in asking], np.int64)
        i, j = Vocabulary(words, asking).with_one_error(asking, sizes, right_exact)
        if right_exact:  # what also keeps the first half has been found there
            other = [k for k, (x, y) in enumerate(zip(i.tolist(), j.tolist())) if not words[y].startswith(asking[x][:len(asking[x]) // 2])]
            i, j = i[other], j[other]
        n = np.array([texts[w] for w in words], np.int64)
        order = np.lexsort((j, -n[j], i))
        i, j = i[order], j[order]
        first = np.flatnonzero(np.append(True, i[1:] != i[:-1])) if len(i) else np.zeros(0, np.int64)
        return pa.table({"word": pa.array([asking[x].decode("latin-1") for x in i[first].tolist()], pa.string()),
                         "n_near": pa.array(np.diff(np.append(first, len(i))), pa.int64()), "form_n": pa.array(n[j[first]], pa.int64()),
                         "form": pa.array([words[y].decode("latin-1") for y in j[first].tolist()], pa.string())})

    return run


def near_words(words: DataFrame, folder: str, part_rows: int = PART) -> DataFrame:
    """(word, n_near, form, form_n) of the words of `words` (word, n; distinct, of Latin-1
    letters) that differ from another one by one inserted, deleted or replaced code point: how
    many do, and the most frequent of them, the first in code point order among ties."""
    found = None
    for right_exact in (False, True):
        rows, n_parts = _parts(stored(_halves(words, right_exact), f"{folder}/halves-{int(right_exact)}"), part_rows)
        width = max(words.sparkSession.sparkContext.defaultParallelism, -(-n_parts // PARTS_PER_TASK))
        one = rows.repartition(width, "part").groupBy("part").applyInArrow(_search(right_exact), "word string, n_near long, form_n long, form string")
        found = one if found is None else found.union(one)
    best = F.min(F.struct((-F.col("form_n")).alias("less"), "form"))
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("b")).select("word", "n_near", F.col("b.form").alias("form"), (-F.col("b.less")).alias("form_n"))


def roots(forms: DataFrame, folder: str) -> DataFrame:
    """(word, root) of `forms` (word, form): the last of a word's forms' forms. Each step
    doubles the distance; a form is RATIO times as frequent, so there are few."""
    now, step = stored(forms.select("word", F.col("form").alias("root")), f"{folder}/roots-0"), 0
    while True:
        onward = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        step += 1
        after = stored(now.join(onward, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), f"{folder}/roots-{step}")
        if after.filter("moved").isEmpty():
            return now
        now = after.select("word", "root")


def spelling_variants(docs: DataFrame, part_rows: int = PART) -> DataFrame:
    """Words of `docs` (doc_id, text) as in `vocabulary`, one row each: word, form, root, n,
    n_near, form_n.

    `n_near` counts the words one code point away, `form` is the most frequent of them (the
    first in code point order among ties) if it occurs RATIO times as often as the word, else
    null, with its count `form_n`; `root` is the form's form and so on to the last, the word
    itself without any.

    Null and empty texts have no words. Rows without doc_id, and rows that repeat one or a text,
    each count. Texts and words may have any length; a word goes to four parts with its
    text, so a part's memory grows with the words' length, not with the corpus. Other columns
    are not read; an empty table gives an empty one.
    """
    spark: SparkSession = docs.sparkSession
    importable(spark)
    folder = new_folder(spark, "spelling")
    words = stored(vocabulary(docs), f"{folder}/words")
    near = stored(near_words(words, folder, part_rows), f"{folder}/near")
    held = words.join(near, "word", "left").withColumn("variant", F.coalesce(F.col("form_n") >= RATIO * F.col("n"), F.lit(False)))
    known = stored(held.select("word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), F.when(F.col("variant"), F.col("form")).alias("form"), F.when(F.col("variant"), F.col("form_n")).alias("form_n")), f"{folder}/known")
    ends = roots(known.filter("form is not null"), folder)
    return known.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def op13_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spelling variants among the words of all documents."""
    return spelling_variants(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
