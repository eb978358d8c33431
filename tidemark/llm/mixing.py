"""Mixing sources to target weights by Pareto order sampling.

Each source has a target in words. A document's expected number of copies is its
weight times a factor of its source, at most `MOST`; short documents weigh more than
long ones, by the binary order of their size, so that a target is met by many
documents rather than by few long ones. The whole part of that number is taken for
certain. The fraction is the probability of one more copy, and a sample of fixed size
in words is drawn with these probabilities: documents are ranked by random odds over
inclusion odds, and the first ones are taken as long as they fit into the source's
words. One more, whose size comes nearest to what is left, closes the gap.

The draw is a hash of the document's id, so a rerun or a lost task draws the same.
A source's rank is never formed over all its rows: words are summed by cells of the
ranking value, twice, and only the cell in which the target is reached is sorted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from tidemark.llm.tables import stored
from tidemark.sources.shared import new_folder

WORD = r"[^\x20\x09-\x0D]+"
#: Weights of the sources by code point, null last, repeating.
WEIGHTS = (3, 1, 2)
#: All targets together, as a share of all words.
SHARE = 1.5
#: No document is taken more often.
MOST = 2
#: Cells of the ranking value per step.
CELLS = 4096
#: Rows of the plan (sources x orders of size) that may be sent to every task.
BROADCAST_ROWS = 1_000_000
LEAST_ID = -(1 << 63)
ADDED = ("mix_size", "mix_source_size", "mix_target", "mix_copies")
CUT = {"last_key": "double", "last_id": "long", "more_key": "double", "more_id": "long"}


def size_of(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def _order(size: Column) -> Column:
    """Binary order of a size: the length of its binary text, 0 for none."""
    return F.when(size > 0, F.length(F.bin(size))).otherwise(0)


def _weight(order: Column) -> Column:
    return F.lit(1.0) / (order + 4)


def _draw(seed: int) -> Column:
    """Uniform in (0, 1), from 48 bits of a digest of a row's id and text."""
    digest = F.md5(F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary"))
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("long").cast("string"), F.lit("null")), F.lit(":"), digest)
    return (F.conv(F.substring(F.md5(text), 1, 12), 16, 10).cast("double") + 0.5) / float(1 << 48)


def targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """(source, source_size, target) of (source, size): the sources' shares by weight,
    each at most `most` times its own size, the excess reshared by weight. With the
    sources in order of size over weight, those before some point are at their limit
    and the others have weight times one level."""
    per_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    # One row per source from here on.
    place = F.row_number().over(Window.orderBy(F.asc_nulls_last("source"))) - 1
    weighed = per_source.withColumn("place", place).withColumn("w", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), F.pmod("place", F.lit(len(weights))) + 1))
    limited = weighed.withColumn("limit", F.lit(float(most)) * F.col("source_size"))
    order = Window.orderBy(F.col("limit") / F.col("w"), "place")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    rest = order.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.partitionBy()
    leveled = limited.withColumn("level", (F.lit(share) * F.sum("source_size").over(everything) - F.coalesce(F.sum("limit").over(before), F.lit(0.0))) / F.sum("w").over(rest))
    # The level of the first source that stays below its limit holds for all after it.
    chosen = leveled.withColumn("at", F.min(F.when(F.col("limit") >= F.col("w") * F.col("level"), F.struct(F.col("limit") / F.col("w"), "place", "level"))).over(everything))
    return chosen.select("source", "source_size", F.coalesce(F.least("limit", F.col("w") * F.col("at.level")), F.col("limit")).alias("target"))


def plan(sizes: DataFrame, wanted: DataFrame, most: int = MOST) -> DataFrame:
    """(source, order, source_size, target, whole, chance, last_key, last_id, more_key,
    more_id): a document of a source and order of size is taken `whole` times, and once
    more if its (ranking value, id) is at most (last_key, last_id), or (more_key, more_id)."""
    sized = sizes.filter("size > 0").withColumn("order", _order(F.col("size")))
    per_order = sized.groupBy("source", "order").agg(F.sum("size").alias("words"))
    joined = _by_source(per_order, wanted).select("source", "order", "words", "source_size", "target", _weight(F.col("order")).alias("g"))
    # The factor of each source, found like the level above: short ones reach the limit first.
    inside = Window.partitionBy("source").orderBy("order")
    before = inside.rowsBetween(Window.unboundedPreceding, -1)
    rest = inside.rowsBetween(0, Window.unboundedFollowing)
    factor = (F.col("target") - F.coalesce(F.sum(F.col("words") * float(most)).over(before), F.lit(0.0))) / F.sum(F.col("words") * F.col("g")).over(rest)
    at = F.min(F.when(F.col("g") * F.col("factor") <= float(most), F.struct("order", "factor"))).over(Window.partitionBy("source"))
    copies = joined.withColumn("factor", factor).withColumn("at", at).withColumn(
        "copies", F.coalesce(F.least(F.lit(float(most)), F.col("g") * F.col("at.factor")), F.lit(float(most))))
    split = copies.withColumn("whole", F.floor("copies")).withColumn("chance", F.col("copies") - F.col("whole")).withColumn(
        "wanted", F.col("target") - F.sum(F.col("words") * F.col("whole")).over(Window.partitionBy("source"))).select(
        "source", "order", "source_size", "target", "whole", "chance", "wanted")
    cut = _closed(ranked := _ranked(sized, split), _cuts(ranked))
    return _by_source(split, cut, "left").drop("wanted")


def _by_source(left: DataFrame, right: DataFrame, how: str = "inner", *also: str) -> DataFrame:
    """Joins by source, null being one, and further columns; the left ones stay."""
    keys = ["source", *also]
    renamed = right.select(*[F.col(c).alias(f"{c}_r" if c in keys else c) for c in right.columns])
    return left.join(renamed, [F.col(k).eqNullSafe(F.col(f"{k}_r")) for k in keys], how).drop(*[f"{k}_r" for k in keys])


def _key(u: Column, chance: Column) -> Column:
    chance = F.nullif(chance, F.lit(0.0))
    return (u / (1 - u)) / (chance / (1 - chance))


def _ranked(sized: DataFrame, split: DataFrame) -> DataFrame:
    few = split.filter("chance > 0").select("source", "order", "chance", "wanted")
    joined = _by_source(sized, few, "inner", "order").select("source", "doc_id", "size", "wanted", _key(F.col("u"), F.col("chance")).alias("key"))
    place = F.col("key") / (1 + F.col("key")) * CELLS
    return joined.withColumn("cell", F.least(F.floor(place), F.lit(CELLS - 1))).withColumn(
        "fine", F.least(F.floor((place - F.col("cell")) * CELLS), F.lit(CELLS - 1)))


def _reached(rows: DataFrame, by: str) -> DataFrame:
    """(source, left, at): the cell of each source in which its words are reached, and
    what is wanted of that cell."""
    sums = rows.groupBy("source", by).agg(F.sum("size").alias("words"), F.first("wanted").alias("wanted"))
    order = Window.partitionBy("source").orderBy(by).rowsBetween(Window.unboundedPreceding, -1)
    before = sums.withColumn("before", F.coalesce(F.sum("words").over(order), F.lit(0))).filter("before < wanted")
    last = Window.partitionBy("source").orderBy(F.desc(by))
    return before.withColumn("n", F.row_number().over(last)).filter("n = 1").select(
        "source", (F.col("wanted") - F.col("before")).alias("left"), F.col(by).alias("at"))


def _cuts(ranked: DataFrame) -> DataFrame:
    """(source, last_key, last_id, gap): the last document of each source that fits,
    and the words that are left then."""
    first = _reached(ranked, "cell")
    in_cell = _by_source(ranked.drop("wanted"), first.withColumnRenamed("left", "wanted")).filter("cell = at").drop("at")
    second = _reached(in_cell, "fine")
    in_fine = _by_source(in_cell, second).filter("fine = at")
    order = Window.partitionBy("source").orderBy("key", "doc_id", "size").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    taken = in_fine.withColumn("sum", F.sum("size").over(order)).filter("sum <= left")
    inside = taken.groupBy("source").agg(F.max(F.struct("key", _id())).alias("last"), F.sum("size").alias("words"))
    # Where none of the cell fits, all up to the cell's start do.
    cells = _by_source(first.select("source", F.col("at").alias("coarse")), second)
    start = cells.select("source", "left", ((F.col("coarse") + F.col("at") / CELLS) / CELLS).alias("place"))
    return _by_source(start, inside, "left").select(
        "source", F.coalesce("last.key", F.col("place") / (1 - F.col("place"))).alias("last_key"), F.coalesce("last.id", F.lit(LEAST_ID)).alias("last_id"),
        (F.col("left") - F.coalesce("words", F.lit(0))).alias("gap"))


def _closed(ranked: DataFrame, cuts: DataFrame) -> DataFrame:
    """Adds more_key, more_id: of the documents after the last, the one whose size
    comes nearest to the gap, if it makes it smaller."""
    after = _by_source(ranked.select("source", "doc_id", "size", "key"), cuts).filter(
        ((F.col("key") > F.col("last_key")) | ((F.col("key") == F.col("last_key")) & (_id() > F.col("last_id")))) & (F.abs(F.col("size") - F.col("gap")) < F.col("gap")))
    nearest = after.groupBy("source").agg(F.min(F.struct(F.abs(F.col("size") - F.col("gap")).alias("off"), "key", _id())).alias("n"))
    return _by_source(cuts.drop("gap"), nearest, "left").select("source", "last_key", "last_id", F.col("n.key").alias("more_key"), F.col("n.id").alias("more_id"))


def _id() -> Column:
    return F.coalesce(F.col("doc_id").cast("long"), F.lit(LEAST_ID)).alias("id")


def mixed(docs: DataFrame, weights=WEIGHTS, share: float = SHARE, most: int = MOST, seed: int = 7) -> DataFrame:
    """`docs` with mix_size, mix_source_size, mix_target and mix_copies, the number of
    times the mix takes each row. All other columns of `docs` stay.

    Sizes are words. A null or empty text has size 0 and is never taken; so have rows
    of a source without words. A null source is a source of its own, the last. Rows
    with equal ids and texts draw alike, so all or none of them get the extra copy.
    An empty table gives an empty mix.
    """
    spark = docs.sparkSession
    folder = new_folder(spark, "mix")
    id_type = F.col("doc_id").cast("long").alias("doc_id")
    sizes = stored(docs.select(id_type, F.col("source").cast("string").alias("source"), size_of(F.col("text")).alias("size"), _draw(seed).alias("u")), f"{folder}/sizes")
    wanted = stored(targets(sizes, weights, share, most), f"{folder}/targets")
    by_order = stored(plan(sizes, wanted, most), f"{folder}/plan")
    return _decided(docs, wanted, by_order, seed)


def _decided(docs: DataFrame, wanted: DataFrame, by_order: DataFrame, seed: int) -> DataFrame:
    own = docs.columns
    empty = wanted.select("source", F.lit(0).alias("order"), "source_size", "target", F.lit(0).cast("long").alias("whole"), F.lit(0.0).alias("chance"),
                          *[F.lit(None).cast(t).alias(c) for c, t in CUT.items()])
    full = empty.union(by_order.select(*empty.columns))
    full = full.select(*[F.col(c).alias(f"__mix_{c}") for c in full.columns])
    few = full.count() <= BROADCAST_ROWS
    tagged = docs.withColumn("__mix_size", size_of(F.col("text"))).withColumn("__mix_o", _order(F.col("__mix_size"))).withColumn("__mix_u", _draw(seed))
    joined = tagged.join(F.broadcast(full) if few else full, F.col("source").cast("string").eqNullSafe(F.col("__mix_source")) & (F.col("__mix_o") == F.col("__mix_order")))
    mix = lambda c: F.col(f"__mix_{c}")
    key, own_id = _key(mix("u"), mix("chance")), _id()
    more = (mix("chance") > 0) & ((key < mix("last_key")) | ((key == mix("last_key")) & (own_id <= mix("last_id"))) | ((key == mix("more_key")) & (own_id == mix("more_id"))))
    copies = mix("whole") + F.coalesce(more, F.lit(False)).cast("long")
    kept = [F.col(f"`{c}`") for c in own if c not in ADDED]
    return joined.select(*kept, mix("size").alias("mix_size"), mix("source_size").alias("mix_source_size"), mix("target").alias("mix_target"), copies.alias("mix_copies"))


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mix of all documents: words taken of each."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "source", "text")
    return mixed(docs).select("doc_id", F.col("mix_size").alias("size"), F.col("mix_source_size").alias("source_size"), F.col("mix_target").alias("target"),
                              (F.col("mix_copies") * F.col("mix_size")).alias("taken"))


SQL = r"""
with sized as (
  select doc_id, source, md5(coalesce(text, '')) as digest, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) as size from documents),
sources as (select source, sum(size)::bigint as source_size from sized group by source),
weighed as (
  select *, 2.0::double * source_size as lim, ([3.0, 1.0, 2.0])[1 + place % 3]::double as w
  from (select *, row_number() over (order by source nulls last) - 1 as place from sources)),
leveled as (
  select *, (1.5::double * (sum(source_size) over ())::double
      - coalesce(sum(lim) over (order by lim / w, place rows between unbounded preceding and 1 preceding), 0::double))
      / sum(w) over (order by lim / w, place rows between current row and unbounded following) as level
  from weighed),
wanted as (
  select source, source_size, coalesce(least(lim, w * (select arg_min(level, lim / w) from leveled where lim >= w * level)), lim) as target from leveled),
orders as (
  select source, o, sum(size) as words, 1.0::double / (o + 4) as g
  from (select *, case when size > 0 then length(bin(size)) else 0 end as o from sized) where size > 0 group by source, o),
factored as (
  select orders.*, target, (target - coalesce(sum(words * 2.0::double) over (partition by orders.source order by o rows between unbounded preceding and 1 preceding), 0::double))
      / sum(words * g) over (partition by orders.source order by o rows between current row and unbounded following) as factor
  from orders join wanted on orders.source is not distinct from wanted.source),
copied as (
  select *, coalesce(least(2.0::double, g * (min_by(factor, o) filter (where g * factor <= 2.0::double) over (partition by source))), 2.0::double) as copies from factored),
split as (
  select *, floor(copies) as whole, copies - floor(copies) as chance,
    target - sum(words * floor(copies)) over (partition by source) as wanted_more from copied),
keyed as (
  select d.doc_id, d.source, d.size, whole, chance, wanted_more,
    case when chance > 0 then (u / (1 - u)) / (chance / (1 - chance)) end as key
  from (select *, case when size > 0 then length(bin(size)) else 0 end as o,
          (('0x' || substr(md5('7:' || coalesce(doc_id::varchar, 'null') || ':' || digest), 1, 12))::bigint::double + 0.5) / 281474976710656.0 as u from sized) d
  left join split s on d.source is not distinct from s.source and d.o = s.o),
summed as (
  select *, sum(case when key is null then 0 else size end) over (partition by source order by key nulls last, doc_id rows unbounded preceding) as upto from keyed),
fitting as (
  select *, key is not null and upto <= wanted_more as fits,
    wanted_more - sum(case when key is not null and upto <= wanted_more then size else 0 end) over (partition by source) as gap from summed),
closing as (
  select source, arg_min(doc_id, (abs(size - gap), key)) as more_id from fitting
  where key is not null and not fits and abs(size - gap) < gap group by source)
select k.doc_id, k.size::bigint as size, w.source_size, w.target,
  (k.size * (coalesce(whole, 0) + case when coalesce(fits, false) or k.doc_id = c.more_id then 1 else 0 end))::bigint as taken
from fitting k join wanted w on k.source is not distinct from w.source
left join closing c on k.source is not distinct from c.source
"""
