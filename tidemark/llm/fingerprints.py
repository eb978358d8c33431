"""Document fingerprints by order MinHash.

A text's k-mers of words are numbered by occurrence, so that a repeated one counts
each time. Their hashes fall into bins; of each bin the least ones are selected, put
back into the order of the text, and hashed as a tuple. Two texts share a bin's value
if they have the same least k-mers in the same order, so the share of equal values
falls with the edits between them, moved passages included.

All steps are array expressions on a row. A k-mer is one long: its hash above its
position, so that sorting longs orders by hash and, within equal ones, by position.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

#: Words per k-mer, k-mers per bin, and bits of the number of bins.
K, LENGTH, BIN_BITS = 2, 2, 6
#: Bits of a position; texts of more words lose the order of those beyond.
POSITION_BITS = 28
#: Documents ordered by one window, and the number of windows at most.
BLOCK_ROWS, BLOCKS = 2048, 100_000
LEAST_ID = -(1 << 63)

_HASH = -(1 << POSITION_BITS)
_POSITION = (1 << POSITION_BITS) - 1


def _kmer(hashed: Column, position: Column) -> Column:
    return hashed.bitwiseAND(F.lit(_HASH)).bitwiseOR(position.cast("long").bitwiseAND(F.lit(_POSITION)))


def _hash(kmer: Column) -> Column:
    return F.shiftright(kmer, POSITION_BITS)


def _position(kmer: Column) -> Column:
    return kmer.bitwiseAND(F.lit(_POSITION))


def _bin(kmer: Column) -> Column:
    return F.shiftrightunsigned(kmer, 64 - BIN_BITS)


def _occurrence(kmers: Column, i: Column) -> Column:
    """How many equal hashes stand before place i of sorted k-mers, by bisection."""
    steps = F.array(*[F.lit(1 << b) for b in range(POSITION_BITS - 1, -1, -1)])
    same = lambda j: F.when(i - j >= 0, _hash(kmers[i - j]) == _hash(kmers[i])).otherwise(False)
    return F.aggregate(steps, F.lit(0), lambda n, b: F.when(same(n + b), n + b).otherwise(n))


def with_fingerprint(df: DataFrame, text: str, name: str) -> DataFrame:
    """Adds `name`, the fingerprint of a text column: per bin that holds a k-mer, in
    order of bins, the bin's number above 16 bits of its tuple's hash. Null and texts
    without words have an empty array; texts of fewer than K words one k-mer."""
    t = "_order_minhash_"
    words = F.array_remove(F.split(F.coalesce(F.col(text), F.lit("")), r"[\x20\x09-\x0D]+"), "")
    h = F.col(t + "words")
    out = df.withColumn(t + "words", F.transform(words, lambda w: F.xxhash64(w)))
    n = F.size(h)
    runs = F.transform(F.slice(h, 1, F.greatest(n - (K - 1), F.lit(0))), lambda x, i: _kmer(F.xxhash64(x, *[h[i + j] for j in range(1, K)]), i))
    short = F.filter(F.array(_kmer(F.xxhash64(F.array_join(h.cast("array<string>"), " ")), F.lit(0))), lambda x: n > 0)
    out = out.withColumn(t + "sorted", F.sort_array(F.when(n >= K, runs).otherwise(short)))
    # no element is null, so that the arrays are sorted as plain longs
    s = F.col(t + "sorted")
    fresh = lambda x, i: F.when(i == 0, True).otherwise(_hash(s[i - 1]) != _hash(x))
    numbered = F.transform(s, lambda x, i: F.when(fresh(x, i), x).otherwise(_kmer(F.xxhash64(_hash(x), _occurrence(s, i)), _position(x))))
    out = out.withColumn(t + "numbered", F.sort_array(numbered))
    m = F.col(t + "numbered")
    out = out.withColumn(t + "least", F.filter(m, lambda x, i: F.when(i < LENGTH, True).otherwise(_bin(m[i - LENGTH]) != _bin(x))))
    k = F.col(t + "least")
    # the places of a bin's first k-mer; its others follow
    places = F.filter(F.transform(k, lambda x, i: i), lambda i: F.when(i == 0, True).otherwise(_bin(k[i - 1]) != _bin(k[i])))

    def value(i: Column) -> Column:
        mine = F.filter(F.slice(k, i + 1, LENGTH), lambda x: _bin(x) == _bin(k[i]))
        in_order = F.transform(F.sort_array(F.transform(mine, lambda x: F.struct(_position(x).alias("p"), _hash(x).alias("h")))), lambda e: e["h"])
        tuple_hash = F.aggregate(in_order, F.lit(0).cast("long"), lambda a, x: F.xxhash64(a, x))
        return F.shiftleft(_bin(k[i]), 16).bitwiseOR(tuple_hash.bitwiseAND(F.lit(0xFFFF))).cast("int")

    out = out.withColumn(name, F.transform(places, value))
    return out.drop(*[t + c for c in ("words", "sorted", "numbered", "least")])


def likeness(a: Column, b: Column) -> Column:
    """Share of bins, of those that either has, with equal values; 1 for two empty ones."""
    bins = lambda x: F.transform(x, lambda v: F.shiftright(v, 16))
    either = F.size(F.array_union(bins(a), bins(b)))
    return F.when(either == 0, F.lit(1.0)).otherwise(F.size(F.array_intersect(a, b)) / either)


def as_text(fingerprint: Column) -> Column:
    """Six hexadecimal digits per bin: two for its number, four for its value."""
    return F.array_join(F.transform(fingerprint, lambda v: F.lpad(F.hex(v), 6, "0")), "")


def with_next(docs: DataFrame, *columns: str) -> DataFrame:
    """`docs` with next_<column> of the next row in descending doc_id, the first row's
    for the last; null ids come last, ties go by `columns`.

    Ids are cut into blocks by value, so that windows run over some thousand rows each
    if ids are spread evenly. A block's first row is also sent to the block above, whose
    last row it follows.
    """
    ids = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(LEAST_ID)).alias("__order"))
    low, high, n = ids.agg(F.min(F.when(F.col("__order") > LEAST_ID, F.col("__order"))), F.max("__order"), F.count("*")).first()
    low, high = (low, high) if low is not None else (0, 0)
    width = max(1, -(-(high - low + 1) // max(1, min(BLOCKS, -(-n // BLOCK_ROWS)))))
    block = F.when(F.col("__order") == LEAST_ID, F.lit(-1)).otherwise(F.floor((F.col("__order").cast("decimal(20,0)") - low) / F.lit(width).cast("decimal(20,0)"))).cast("long")
    # One row per block: at most BLOCKS + 1.
    heads = ids.groupBy(block.alias("block")).agg(F.max("__order").alias("head"))
    below = F.lag("head").over(Window.orderBy("block"))
    tails = heads.select(F.coalesce(below, F.max("head").over(Window.partitionBy())).alias("tail"), F.col("block").alias("above"))
    tails = tails.select(F.col("tail").alias("__tail"), F.col("above").alias("__above"))
    placed = docs.withColumn("__order", F.coalesce(F.col("doc_id").cast("long"), F.lit(LEAST_ID)))
    own = F.struct(block.alias("__block"), F.lit(0).alias("__copy"))
    also = F.struct(F.col("__above").alias("__block"), F.lit(1).alias("__copy"))
    copied = placed.join(F.broadcast(tails), F.col("__order") == F.col("__tail"), "left").withColumn(
        "__e", F.explode(F.when(F.col("__above").isNull(), F.array(own)).otherwise(F.array(own, also)))).select(*docs.columns, "__order", "__e.*")
    order = Window.partitionBy("__block").orderBy("__copy", F.desc("__order"), *columns)
    following = copied.withColumns({f"next_{c}": F.lead(c).over(order) for c in columns})
    return following.filter("__copy = 0").drop("__copy", "__block", "__order")


def op9_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of all documents and of their edited texts.

    A null text counts as empty. Rows that repeat an id follow each other by text.
    """
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    own = with_next(with_fingerprint(docs, "text", "print"), "text", "print")
    n = F.length("text")
    half = F.floor(n / 2).cast("int")
    edited = own.withColumn("n_chars", n.cast("long")).withColumn(
        "edited", F.concat(F.substring(F.col("text"), F.lit(1), n - half), F.substring(F.col("next_text"), F.lit(1), half)))
    both = with_fingerprint(edited.drop("text", "next_text"), "edited", "edited_print")
    return both.select("doc_id", "n_chars", F.sha2(F.col("edited"), 256).alias("edited_sha256"), as_text(F.col("print")).alias("fingerprint"),
                       as_text(F.col("edited_print")).alias("edited_fingerprint"), likeness(F.col("print"), F.col("edited_print")).alias("near_edited"),
                       likeness(F.col("print"), F.col("next_print")).alias("near_next"))
