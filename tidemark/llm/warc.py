"""WARC archives: writing captures, and assembling them again from their records.

A capture is three records: a request, a response or revisit, and metadata, the first
and last of which name the second by WARC-Concurrent-To. A payload of `REVISITED` bytes
or more that several captures share is stored once, by the capture of the largest
page_id; the others revisit it. Reading verifies lengths and digests, joins the records
by their identifiers, wherever they lie, and gives one nested row per capture.

A record ends with two line ends; Spark's text writer puts them after every row, so the
archives are written by its committer to any file system.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark.llm.binary_files import read_files, write_records
from tidemark.llm.tables import stored
from tidemark.llm.workers import importable
from tidemark.sources.shared import new_folder

VERSION = "WARC/1.1"
#: All captures bear one date, so that a rerun writes equal archives.
DATE = "2024-01-01T00:00:00Z"
REVISITED = 1000
#: Records per file.
PER_FILE = 6000
EOL, ENDING = "\r\n", "\r\n\r\n"


def _record(kind: Column, own: Column, block: Column, *fields: tuple[str, Column]) -> Column:
    """A record's text without its ending. A field that is null is left out."""
    head = [F.lit(f"{VERSION}{EOL}WARC-Type: "), kind, F.lit(f"{EOL}WARC-Record-ID: "), own, F.lit(f"{EOL}WARC-Date: {DATE}{EOL}")]
    for name, value in fields:
        head.append(F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit(EOL)), F.lit("")))
    return F.concat(*head, F.lit("Content-Length: "), F.octet_length(block).cast("string"), F.lit(ENDING), block)


def _urn(kind: str, *keys: Column) -> Column:
    """A record's identifier from its keys: the same on every run."""
    h = F.md5(F.concat_ws("|", F.lit(kind), *keys))
    cut = [F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *cut), F.lit(">"))


def captures(pages: DataFrame, folder: str) -> DataFrame:
    """Each row of (page_id, url, html) with what its records need: digest, bytes, n (its
    number among rows equal to it), kind, and revisited (the record it refers to)."""
    html = F.coalesce(F.col("html").cast("string"), F.lit(""))
    url = F.col("url").cast("string")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), url.alias("url"), html.alias("html"))
    keyed = rows.withColumn("digest", F.sha1(F.col("html").cast("binary"))).withColumn("bytes", F.octet_length("html").cast("long"))
    keyed = keyed.withColumn("uid", F.md5(F.concat_ws("|", F.coalesce(F.col("page_id").cast("string"), F.lit("null")), "digest", F.coalesce(F.concat(F.lit("u"), "url"), F.lit("null")))))
    narrow = stored(keyed.filter(F.col("bytes") >= REVISITED).groupBy("uid").agg(
        F.min("page_id").alias("page_id"), F.min("digest").alias("digest"), F.count("*").alias("copies")), f"{folder}/large")
    # one row per payload that several captures share
    least = F.coalesce(F.col("page_id"), F.lit(-(1 << 63)))
    tops = narrow.groupBy("digest").agg(F.max(F.struct(least.alias("p"), "uid")).alias("top"), F.sum("copies").alias("sharing")).filter("sharing > 1")
    roles = narrow.select("uid", "digest").join(tops, "digest").select("uid", F.col("top.uid").alias("top"))
    grouped = keyed.groupBy("uid").agg(*[F.first(c).alias(c) for c in ("page_id", "url", "html", "digest", "bytes")], F.count("*").alias("copies"))
    each = grouped.join(roles, "uid", "left").withColumn("n", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
    again = F.col("top").isNotNull() & ((F.col("top") != F.col("uid")) | (F.col("n") > 1))
    return each.withColumn("kind", F.when(again, "revisit").otherwise("response")).withColumn(
        "capture", _urn("capture", F.col("uid"), F.col("n").cast("string"))).withColumn(
        "revisited", F.when(again, _urn("capture", F.col("top"), F.lit("1"))))


def write_archives(pages: DataFrame, folder: str, work: str) -> None:
    """Writes the archives of all rows to `folder`, compressed. A null html is an empty
    payload; a null url has no target field; line ends in a url are percent-encoded."""
    c = captures(pages, work)
    target = F.regexp_replace(F.regexp_replace(F.col("url"), "\r", "%0D"), "\n", "%0A")
    host, path = F.regexp_extract(target, r"^[^:]*://([^/?#]*)", 1), F.regexp_extract(target, r"^[^:]*://[^/?#]*([^#]*)", 1)
    request = F.concat(F.lit("GET "), F.when(path.startswith("/"), path).otherwise(F.concat(F.lit("/"), path)), F.lit(f" HTTP/1.1{EOL}Host: "), host, F.lit(ENDING))
    status = F.concat(F.lit(f"HTTP/1.1 200 OK{EOL}Content-Type: text/html; charset=utf-8{EOL}Content-Length: "), F.col("bytes").cast("string"), F.lit(ENDING))
    digest = F.concat(F.lit("sha1:"), F.col("digest"))
    http = F.lit("application/http; msgtype=")
    own = [_record(F.lit("request"), _urn("request", "capture"), F.coalesce(request, F.lit(f"GET / HTTP/1.1{ENDING}")), ("WARC-Target-URI", target),
                   ("WARC-Concurrent-To", F.col("capture")), ("Content-Type", F.concat(http, F.lit("request")))),
           _record(F.col("kind"), F.col("capture"), F.when(F.col("kind") == "response", F.concat(status, "html")).otherwise(status), ("WARC-Target-URI", target),
                   ("WARC-Payload-Digest", digest), ("WARC-Refers-To", F.col("revisited")), ("Content-Type", F.concat(http, F.lit("response"))),
                   ("WARC-Profile", F.when(F.col("kind") == "revisit", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"))),
           _record(F.lit("metadata"), _urn("metadata", "capture"), F.concat(F.lit("page-id: "), F.coalesce(F.col("page_id").cast("string"), F.lit("")), F.lit(EOL)),
                   ("WARC-Target-URI", target), ("WARC-Concurrent-To", F.col("capture")), ("Content-Type", F.lit("application/warc-fields")))]
    write_records(c.select(F.explode(F.array(*own)).alias("record")), "record", folder, ENDING, "gzip", PER_FILE)


def records_of(content: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(header fields in lower case, block) of each record of an archive, plain or of
    one or more gzip members."""
    if content[:2] == b"\x1f\x8b":
        parts = []
        while content:
            member = zlib.decompressobj(31)
            parts.append(member.decompress(content))
            content = member.unused_data
        content = b"".join(parts)
    at = 0
    while at < len(content):
        end = content.index(b"\r\n\r\n", at)
        lines = content[at:end].decode("utf-8").split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"no WARC record at byte {at}")
        fields = {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines[1:])}
        n = int(fields["content-length"])
        block = content[end + 4:end + 4 + n]
        at = end + 4 + n
        if len(block) != n or content[at:at + 4] != b"\r\n\r\n":
            raise ValueError(f"record {fields.get('warc-record-id')} does not end where it says")
        at += 4
        yield fields, block


RECORD = "kind string, id string, concurrent_to string, refers_to string, uri string, payload_bytes long, payload_digest string, page_id long, block binary"


def read_records(spark: SparkSession, folder: str, blocks: bool = True) -> DataFrame:
    """All records of the archives. Bytes and digest are those of a response's payload,
    counted and hashed as it is read; a stored digest that differs is an error."""
    importable(spark)

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("kind", pa.string()), ("id", pa.string()), ("concurrent_to", pa.string()), ("refers_to", pa.string()), ("uri", pa.string()),
                            ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("page_id", pa.int64()), ("block", pa.binary())])
        for batch in batches:
            for content in batch.column("content"):
                rows, held = [], 0
                for f, block in records_of(content.as_buffer().to_pybytes()):
                    kind, size, digest, page = f["warc-type"], None, None, None
                    if kind == "response":
                        payload = block.partition(b"\r\n\r\n")[2]
                        size, digest = len(payload), hashlib.sha1(payload).hexdigest()
                        if f.get("warc-payload-digest", f"sha1:{digest}") != f"sha1:{digest}":
                            raise ValueError(f"payload of {f['warc-record-id']} has another digest")
                    elif kind == "metadata":
                        page = next((line[9:].strip() for line in block.decode().split("\r\n") if line.startswith("page-id: ")), "")
                    rows.append((kind, f["warc-record-id"], f.get("warc-concurrent-to"), f.get("warc-refers-to"), f.get("warc-target-uri"), size, digest,
                                 int(page) if page else None, block if blocks else None))
                    held += len(block)
                    if len(rows) >= 5000 or blocks and held > 1 << 24:
                        yield pa.RecordBatch.from_pylist([dict(zip(schema.names, r)) for r in rows], schema)
                        rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist([dict(zip(schema.names, r)) for r in rows], schema)

    return read_files(spark.read, folder).select("content").mapInArrow(parse, RECORD)


def assembled(records: DataFrame) -> DataFrame:
    """One nested row per capture: its response or revisit, the request and the metadata
    concurrent to it (null where there is none; of several the one with the least id, and
    their number), and for a revisit the response it refers to, null if that is missing."""
    nested = [c for c in records.columns if c != "kind"]
    main = records.filter(F.col("kind").isin("response", "revisit")).select("kind", F.col("id").alias("capture"), F.struct(*nested).alias("response"))

    def side(kind: str) -> DataFrame:
        rows = records.filter((F.col("kind") == kind) & F.col("concurrent_to").isNotNull())
        return rows.groupBy(F.col("concurrent_to").alias("capture")).agg(F.min(F.struct("id", *[c for c in nested if c != "id"])).alias(kind), F.count("*").alias(f"n_{kind}"))

    joined = main.join(side("request"), "capture", "left").join(side("metadata"), "capture", "left")
    first = joined.filter("kind = 'response'").select(F.col("capture").alias("refers"), F.struct(
        F.col("metadata.page_id").alias("page_id"), F.col("response.payload_bytes").alias("payload_bytes"), F.col("response.payload_digest").alias("payload_digest")).alias("original"))
    again = joined.filter("kind = 'revisit'").join(first, F.col("response.refers_to") == F.col("refers"), "left").drop("refers")
    return joined.filter("kind = 'response'").withColumn("original", F.lit(None).cast(first.schema["original"].dataType)).unionByName(again)


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages, written to archives and assembled from them.

    Null ids are the least ones; of rows with equal id, url and payload the first is
    the response and the others revisit it, if the payload is large.
    """
    folder = new_folder(spark, "warc")
    write_archives(spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html"), f"{folder}/archives", f"{folder}/work")
    found = assembled(stored(read_records(spark, f"{folder}/archives", blocks=False), f"{folder}/records"))
    full = lambda c: F.coalesce(f"response.{c}", f"original.{c}").alias(c)
    return found.select(F.col("metadata.page_id").alias("page_id"), full("payload_bytes"), full("payload_digest"), F.col("kind").alias("record_type"),
                        F.when(F.col("kind") == "revisit", F.col("original.page_id")).alias("refers_to"))


SQL = """
with payloads as (
  select page_id, octet_length(encode(coalesce(html, '')))::bigint as payload_bytes, sha1(coalesce(html, '')) as payload_digest from pages),
tops as (
  select payload_digest as digest, max(page_id) as top from payloads where payload_bytes >= 1000 group by 1)
select page_id, payload_bytes, payload_digest, case when page_id <> top then 'revisit' else 'response' end as record_type,
  case when page_id <> top then top end as refers_to
from payloads left join tops on payload_digest = digest and payload_bytes >= 1000
"""
