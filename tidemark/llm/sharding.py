"""Sharding by vector bin packing.

Rows with equal texts form a group and go to one shard. A group has three measures,
its bytes, words and rows, each as a share of the whole. Groups are placed in order
of their largest measure, each into the shard where the product of its measures with
the shard's residual capacity is highest, so that what a shard lacks most decides.

Packing runs in parallel: groups are dealt into cells of bounded size, each cell packs
its own into bins, and the bins are packed again, until one cell is left, which packs
into shards. A group of more bytes than a shard is split by row id beforehand.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from tidemark.llm.mixing import size_of
from tidemark.llm.tables import stored
from tidemark.llm.workers import importable
from tidemark.sources.shared import new_folder

SHARDS = 40
#: Bytes that each row costs besides its text.
ROW_BYTES = 16
#: Groups packed by one task, or twice the bins it packs into if those are more.
CELL = 20_000
#: Bins per shard that a cell packs into while there are several cells.
BINS = 4
#: Pieces of a group of more bytes than a shard hold at most this part of one.
PIECE = 1 / 4
#: Rows numbered by one task.
NUMBERED = 100_000
MEASURES = ("bytes", "words", "n")


def pack(measures: np.ndarray, bins: int) -> np.ndarray:
    """Bin of each row of (items, measures); every measure adds up to one over all."""
    residual = np.full((bins, measures.shape[1]), 1.0 / bins)
    out = np.zeros(len(measures), np.int32)
    for i in np.argsort(-measures.max(axis=1), kind="stable").tolist():
        b = int(np.argmax(residual @ measures[i]))
        out[i] = b
        residual[b] -= measures[i]
    return out


def _packer(bins: int):
    def run(cell: pd.DataFrame) -> pd.DataFrame:
        cell = cell.sort_values("item").reset_index(drop=True)
        m = cell[list(MEASURES)].to_numpy(np.float64)
        m = m / np.maximum(m.sum(axis=0), 1.0)
        # ids of bins are numbers within (cell, bin), unique over cells
        return pd.DataFrame({"item": cell["item"], "bin": cell["cell"].astype("int64") * bins + pack(m, bins)})

    return run


def _packed(items: DataFrame, shards: int, folder: str) -> DataFrame:
    """(item, shard) of items (item, bytes, words, n). A cell has at least twice as many
    items as bins, so that each level has fewer items than the one before."""
    maps, level, n = [], 0, items.count()
    width = max(CELL, 2 * shards * BINS)
    while True:
        cells = -(-n // width)
        bins = shards if cells <= 1 else shards * BINS
        dealt = items.withColumn("cell", F.pmod(F.xxhash64("item", F.lit(level)), F.lit(max(cells, 1))))
        into = stored(dealt.groupBy("cell").applyInPandas(_packer(bins), "item string, bin long"), f"{folder}/level-{level}")
        maps.append(into)
        if cells <= 1:
            break
        items = stored(items.join(into, "item").groupBy(F.col("bin").cast("string").alias("item")).agg(*[F.sum(m).alias(m) for m in MEASURES]), f"{folder}/bins-{level}")
        before, level, n = n, level + 1, items.count()
        if n >= before:
            raise RuntimeError(f"level {level} of the packing has {n} items after {before}")
    out = maps[0]
    for upper in maps[1:]:
        out = out.join(upper.select(F.col("item").cast("long").alias("bin"), F.col("bin").alias("up")), "bin").select("item", F.col("up").alias("bin"))
    return out.select("item", F.col("bin").cast("int").alias("shard"))


def sharded(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """(doc_id, size, text_crc32, words, shard, slot) of every row of (doc_id, text).

    A null text counts as an empty one. Equal texts share a shard unless their group has
    more bytes than an equal share of all; such a group is split by row id, and rows
    that repeat an id stay together. Slots number the rows of a shard from 0 without
    gaps. An empty table gives an empty result.
    """
    spark = docs.sparkSession
    importable(spark)
    folder = new_folder(spark, "shards")
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = stored(docs.select(F.col("doc_id").cast("long").alias("doc_id"), (F.octet_length(text) + ROW_BYTES).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"),
                              size_of(text).alias("words"), F.md5(text.cast("binary")).alias("key")), f"{folder}/rows")
    groups = rows.groupBy("key").agg(F.sum("size").alias("bytes"), F.sum("words").alias("words"), F.count("*").alias("n"))
    total = rows.agg(F.sum("size"), F.sum("words"), F.count("*")).first()
    if not total[2]:
        return _numbered(rows.withColumn("shard", F.lit(0)), 0)
    # Fewer groups than shards are that large.
    shares = F.col("bytes") / float(total[0]) * shards
    large = groups.filter(shares > 1).select("key", F.ceil(shares / PIECE).cast("int").alias("pieces"))
    piece = F.when(F.col("pieces").isNull(), F.col("key")).otherwise(F.concat_ws("/", "key", F.pmod(F.xxhash64("doc_id"), F.col("pieces")).cast("string")))
    itemed = stored(rows.join(F.broadcast(large), "key", "left").withColumn("item", piece).drop("key", "pieces"), f"{folder}/items")
    items = itemed.groupBy("item").agg(F.sum("size").alias("bytes"), F.sum("words").alias("words"), F.count("*").alias("n"))
    placed = stored(itemed.join(_packed(stored(items, f"{folder}/measures"), shards, folder), "item").drop("item"), f"{folder}/placed")
    return _numbered(placed, total[2], shards)


def _numbered(placed: DataFrame, n: int, shards: int = SHARDS) -> DataFrame:
    """Adds slot: numbers within (shard, part), after those of the shard's earlier parts."""
    parts = max(1, -(-n // (shards * NUMBERED)))
    cut = placed.withColumn("part", F.pmod(F.xxhash64("doc_id"), F.lit(parts)))
    counts = cut.groupBy("shard", "part").agg(F.count("*").alias("c"))
    before = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("shard", "part", F.coalesce(F.sum("c").over(before), F.lit(0)).alias("start"))
    own = F.row_number().over(Window.partitionBy("shard", "part").orderBy("doc_id", "text_crc32")) - 1
    return cut.withColumn("own", own).join(starts, ["shard", "part"]).select(
        "doc_id", "size", "text_crc32", "words", "shard", (F.col("start") + F.col("own")).cast("long").alias("slot"))


def write_shards(docs: DataFrame, placed: DataFrame, folder: str) -> None:
    """Writes rows of unique ids as Parquet, one folder per shard, in order of slots."""
    rows = docs.join(placed.select("doc_id", "shard", "slot"), "doc_id")
    rows.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(folder)


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 40 shards of nearly equal bytes."""
    placed = sharded(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "words")
