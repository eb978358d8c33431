"""From documents to shards of a training mix.

`run` applies the stages of `STAGES` one after another; each reads what the one before
it has written. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.llm.decontaminate import benchmark_items, contaminated
from tidemark.llm.language import in_a_language
from tidemark.llm.mixing import mixed
from tidemark.llm.near_dups import BROADCAST_IDS, linked_classes
from tidemark.llm.sharding import sharded
from tidemark.llm.tables import stored
from tidemark.sources.shared import new_folder

#: Similarity of near duplicates, percent.
SIMILAR = 80
KEY = "__document"


def _keyed(docs: DataFrame, folder: str) -> DataFrame:
    """Adds KEY, equal for rows of one document: the id; a hash of the id and the text where
    rows with one id have different texts, and of the text where there is no id."""
    digests = docs.filter("doc_id is not null").groupBy("doc_id").agg(F.min(F.xxhash64("text")).alias("lo"), F.max(F.xxhash64("text")).alias("hi"))
    shared = stored(digests.filter("lo <> hi").select(F.col("doc_id").alias("__shared")), f"{folder}/shared-ids")
    few = shared.count() <= BROADCAST_IDS
    marked = docs.join(F.broadcast(shared) if few else shared, F.col("doc_id") == F.col("__shared"), "left")
    own = F.when(F.col("__shared").isNotNull(), F.xxhash64("doc_id", "text")).otherwise(F.col("doc_id").cast("long"))
    return marked.withColumn(KEY, F.coalesce(own, F.xxhash64("text"))).drop("__shared")


def _without(keyed: DataFrame, removed: DataFrame, folder: str) -> DataFrame:
    """Rows whose KEY is not among `removed` (doc_id)."""
    gone = stored(removed.select(F.col("doc_id").alias("__gone")).distinct(), folder)
    few = gone.count() <= BROADCAST_IDS
    return keyed.join(F.broadcast(gone) if few else gone, F.col(KEY) == F.col("__gone"), "left_anti")


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in one of the labelled languages; null texts and texts without a letter go."""
    return in_a_language(docs)


def remove_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class, that of the least id. Rows with one id but different
    texts are documents of their own; of rows that repeat an id and a text one stays."""
    folder = new_folder(spark, "dedup")
    keyed = _keyed(docs, folder)
    classes = stored(linked_classes(keyed.select(F.col(KEY).alias("doc_id"), "text"), SIMILAR), f"{folder}/classes")
    left = _without(keyed, classes.filter("not kept"), f"{folder}/removed")
    again = classes.groupBy("doc_id").agg(F.count("*").alias("n")).filter("n > 1").select(F.col("doc_id").alias("__again"))
    if again.isEmpty():
        return left.drop(KEY)
    repeated = left.join(again, F.col(KEY) == F.col("__again"), "left_semi")
    return left.join(again, F.col(KEY) == F.col("__again"), "left_anti").unionByName(repeated.dropDuplicates([KEY])).drop(KEY)


def remove_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no test item."""
    folder = new_folder(spark, "contaminated")
    keyed = _keyed(docs, folder)
    found = contaminated(keyed.select(F.col(KEY).alias("doc_id"), "text"), benchmark_items(spark, sf_dir))
    return _without(keyed, found, f"{folder}/removed").drop(KEY)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    own = docs.columns
    taken = mixed(docs).filter("mix_copies > 0")
    return taken.withColumn("mix_copies", F.explode(F.sequence(F.lit(1), F.col("mix_copies").cast("int")))).select(*[F.col(f"`{c}`") for c in own])


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Shard and slot of each row of the mix."""
    return sharded(docs.select("doc_id", "text"))


STAGES = [
    ("language", identify_language),
    ("near_duplicates", remove_near_duplicates),
    ("decontamination", remove_contaminated),
    ("mixing", mix_sources),
    ("sharding", shard),
]

#: Language identification has no equivalent in SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to documents."""
    folder = new_folder(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"{folder}/{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
