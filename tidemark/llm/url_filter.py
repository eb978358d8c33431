"""URL filters: rules by host and path, and a list of URLs behind a blocked Bloom filter.

Listed URLs set eight bits each, one in each of the eight words of one block of 512
bits. A URL whose block has all of its bits may be listed; only these possible hits,
a small part of the rows, go to an exact join with the list, which removes the false
ones. Building and probing are SQL functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark.llm.tables import stored
from tidemark.sources.shared import new_folder

#: (verdict, host, path): a rule fits its host and all subdomains, and paths that start with its own.
RULES = (("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"), ("allow", "com", "/fr/"), ("block", "com", "/de/"))
#: Host labels whose pages make up the list.
LISTED_HOSTS = ("spam-farm", "cheap-pills")
#: Query parameters that don't change a page.
TRACKING = r"^(utm_[a-z]+|ref)="
#: Bits of the filter per listed URL.
BITS = 24
#: A filter of at most so many blocks (64 bytes each) is sent to every task; a larger one is joined by block.
BROADCAST_BLOCKS = 1 << 20
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    return F.translate(F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def canonical(url: Column) -> Column:
    """Host, path and query that decide what a URL shows: without scheme, www., default
    port, trailing slashes, fragment and tracking parameters; parameters sorted."""
    query = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^?#]*\?([^#]*)", 1)
    kept = F.array_sort(F.filter(F.split(query, "&"), lambda p: (p != "") & ~p.rlike(TRACKING)))
    host = F.regexp_replace(F.regexp_replace(host_of(url), r"^www\.", ""), r":(80|443)$", "")
    return F.concat(host, F.regexp_replace(path_of(url), r"/+$", ""), F.when(F.size(kept) > 0, F.concat(F.lit("?"), F.array_join(kept, "&"))).otherwise(""))


def rule_of(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits, or nulls."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for v, h, p in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        rule, verdict = F.when(fits, F.lit(h + p)).otherwise(rule), F.when(fits, F.lit(v)).otherwise(verdict)
    return rule, verdict


def _masks(url: Column) -> list[Column]:
    bits = F.xxhash64(url, F.lit("bits"))
    return [F.call_function("shiftleft", F.lit(1).cast("long"), F.shiftrightunsigned(bits, 6 * i).bitwiseAND(F.lit(63)).cast("int")) for i in range(8)]


def bloom_blocks(listed: DataFrame, blocks: int) -> DataFrame:
    """(block, w0..w7) of a column `listed`: bits set by its URLs."""
    own = listed.select(F.pmod(F.xxhash64("listed"), F.lit(blocks)).alias("block"), *[m.alias(f"w{i}") for i, m in enumerate(_masks(F.col("listed")))])
    return own.groupBy("block").agg(*[F.bit_or(f"w{i}").alias(f"w{i}") for i in range(8)])


def judged(pages: DataFrame, listed: DataFrame, rules=RULES) -> DataFrame:
    """(page_id, host, path, rule, verdict) of every row of (page_id, url).

    `listed` has one column of URLs. The longest fitting rule decides; where none fits,
    a URL is blocked if its canonical form is that of a listed one, else allowed. A null
    URL or one without `://` has an empty host and path, fits no rule, and is never
    listed. Null and repeated entries of the list change nothing; an empty list blocks
    nothing. Repeated rows are judged alike.
    """
    folder = new_folder(pages.sparkSession, "urls")
    names = stored(listed.select(canonical(F.col(listed.columns[0])).alias("listed")).filter("listed <> ''").distinct(), f"{folder}/listed")
    n = names.count()
    blocks = 1 << max(0, -(-n * BITS // 512) - 1).bit_length()
    bloom = bloom_blocks(names, blocks)
    url = F.col("url").cast("string")
    rows = pages.select("page_id", host_of(url).alias("host"), path_of(url).alias("path"), canonical(url).alias("canonical"))
    rows = rows.withColumn("block", F.pmod(F.xxhash64("canonical"), F.lit(blocks)))
    probed = rows.join(F.broadcast(bloom) if blocks <= BROADCAST_BLOCKS else bloom, "block", "left")
    possible = F.lit(True)
    for i, m in enumerate(_masks(F.col("canonical"))):
        possible = possible & (F.coalesce(F.col(f"w{i}"), F.lit(0).cast("long")).bitwiseAND(m) == m)
    probed = stored(probed.select("page_id", "host", "path", "canonical", possible.alias("possible")), f"{folder}/probed")
    hits = probed.filter("possible").join(names, F.col("canonical") == F.col("listed"), "left").withColumn("hit", F.col("listed").isNotNull())
    every = hits.select("page_id", "host", "path", "hit").union(probed.filter("not possible").select("page_id", "host", "path", F.lit(False)))
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    return every.select("page_id", "host", "path", rule.alias("rule"), F.coalesce(verdict, F.when(F.col("hit"), "block").otherwise("allow")).alias("verdict"))


def listed_pages(pages: DataFrame) -> DataFrame:
    """URLs of pages on the listed hosts."""
    on = F.lit(False)
    for label in LISTED_HOSTS:
        on = on | host_of(F.col("url")).contains(label)
    return pages.filter(on).select("url")


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdicts on all pages."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url")
    return judged(pages, listed_pages(pages))


SQL = r"""
with parts as (
  select page_id, url,
    translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
    regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) as path,
    regexp_extract(coalesce(url, ''), '(?s)^.*?://[^?#]*\?([^#]*)', 1) as query
  from pages),
kept as (
  select *, list_sort(list_filter(string_split(query, '&'), lambda p: p <> '' and not regexp_matches(p, '^(utm_[a-z]+|ref)='))) as params from parts),
named as (
  select *, regexp_replace(regexp_replace(host, '^www\.', ''), ':(80|443)$', '') || regexp_replace(path, '/+$', '')
    || case when len(params) > 0 then '?' || array_to_string(params, '&') else '' end as canonical from kept),
listed as (select distinct canonical from named where canonical <> '' and (contains(host, 'spam-farm') or contains(host, 'cheap-pills'))),
ruled as (
  select *, case
    when (host = 'example.org' or suffix(host, '.example.org')) and prefix(path, '/en/1') then 'example.org/en/1'
    when (host = 'example.org' or suffix(host, '.example.org')) and prefix(path, '/es/') then 'example.org/es/'
    when (host = 'com' or suffix(host, '.com')) and prefix(path, '/fr/') then 'com/fr/'
    when (host = 'com' or suffix(host, '.com')) and prefix(path, '/de/') then 'com/de/'
    when (host = 'org' or suffix(host, '.org')) and prefix(path, '/') then 'org/' end as rule
  from named)
select page_id, host, path, rule, case when rule in ('org/', 'com/fr/') then 'allow' when rule is not null then 'block'
  when canonical in (select canonical from listed) then 'block' else 'allow' end as verdict
from ruled
"""
