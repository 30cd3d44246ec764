"""WARC archives in which equal payloads are stored once.

Headers alone (page id, digest, length) are shuffled by digest: a digest that occurs more than once names the page
that keeps its payload, and every other page is written as a revisit record with fresh headers that refer to it. The
revisits found go back to their pages by page id and digest, a key that few rows share however often a payload
occurs. They are broadcast below ``SMALL`` rows; beyond, pages meet them in a join by that key.

Each record is a gzip member of its own, so archives can be read from any record on. They are written by Spark's own
text writer, to any file system and with the usual commit, so a lost executor leaves no half archive; what separates its lines
is an empty gzip member, which readers of archives pass over. By these an archive is read back in pieces, record by record.

Nulls: a null page is an empty payload; a null url leaves its header out; rows with a null page id are never
originals of others unless all rows of the payload have one. If rows repeat, each row of the smallest id is a
response, and they have one record id. Other columns are ignored. An empty table writes an archive without
records. Payloads may hold anything, record separators too: reading goes by Content-Length.
"""

from __future__ import annotations

import gzip
import hashlib
import io
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strandline.llm._common import cut, scratch, small
from strandline.sources.warc import http, records

MIN_BYTES = 100
#: Revisits that are broadcast at most.
SMALL = 500_000
LEVEL = 6
#: A gzip member without content.
EMPTY = gzip.compress(b"", 9, mtime=0)
TEXT = {"lineSep": EMPTY.decode("latin-1"), "encoding": "ISO-8859-1"}
END = "\r\n\r\n"
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
SCHEMA = "page_id long, url string, record_type string, payload_bytes long, payload_digest string, refers_to long"


def resolve(pages: DataFrame, min_bytes: int = MIN_BYTES) -> DataFrame:
    """pages (page_id, url, html) with digest, bytes and refers_to, the page that keeps the payload (null: this one)."""
    body = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    own = pages.select("page_id", "url", body.alias("body")).withColumn("digest", F.sha2("body", 256)).withColumn("bytes", F.octet_length("body").cast("long"))
    heads = cut(own.where(F.col("bytes") >= min_bytes).select("page_id", F.unhex("digest").alias("key")))
    first = cut(heads.groupBy("key").agg(F.min("page_id").alias("first"), F.count("*").alias("n")).where("n > 1").select("key", "first"))
    later = heads.join(first, "key").where(~F.col("first").eqNullSafe(F.col("page_id"))).select("page_id", "key", "first").distinct()
    later = cut(later)
    same = F.col("p.page_id").eqNullSafe(F.col("r.page_id")) & (F.unhex("p.digest") == F.col("r.key"))
    found = own.alias("p").join(small(later, later.count(), SMALL).alias("r"), same, "left")
    return found.select("p.page_id", "url", "body", "digest", "bytes", F.col("r.first").alias("refers_to"))


def _urn(page: Column) -> Column:
    return F.concat(F.lit("<urn:x-page:"), F.coalesce(page.cast("string"), F.lit("null")), F.lit(">"))


def _record(date: str) -> Column:
    """The bytes of a record and the blank line after it."""
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))
    revisit = F.col("refers_to").isNotNull()
    envelope = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=UTF-8\r\n"), F.lit("Content-Length: "), F.col("bytes").cast("string"), F.lit(END))
    url = F.regexp_replace("url", r"[\x00-\x20\x7F]", "%20")
    length = F.octet_length(envelope) + F.when(revisit, 0).otherwise(F.col("bytes"))
    head = F.concat(
        F.lit("WARC/1.1\r\n"),
        line("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        line("WARC-Record-ID", _urn(F.col("page_id"))),
        line("WARC-Date", F.lit(date)),
        F.coalesce(line("WARC-Target-URI", url), F.lit("")),
        line("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("digest"))),
        F.when(revisit, F.concat(line("WARC-Profile", F.lit(REVISIT)), line("WARC-Refers-To", _urn(F.col("refers_to"))))).otherwise(""),
        line("Content-Type", F.lit("application/http; msgtype=response")),
        line("Content-Length", length.cast("string")),
        F.lit("\r\n"),
        envelope,
    )
    return F.concat(head.cast("binary"), F.when(revisit, F.lit(b"")).otherwise(F.col("body")), F.lit(END.encode()))


def _members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield pa.RecordBatch.from_arrays([pa.array([gzip.compress(r.as_buffer(), LEVEL, mtime=0) for r in batch.column(0)], pa.binary())], names=["value"])


def write_archives(pages: DataFrame, path: str, min_bytes: int = MIN_BYTES, date: str = "2024-01-01T00:00:00Z") -> None:
    """Write archives, one for each partition, under path."""
    packed = resolve(pages, min_bytes).select(_record(date).alias("record")).mapInArrow(_members, "value binary")
    packed.select(F.col("value").cast("string")).write.options(**TEXT).text(path)


def _page(urn: str | None) -> int | None:
    number = (urn or "").removeprefix("<urn:x-page:").removesuffix(">")
    return int(number) if number.lstrip("-").isdigit() else None


def _parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["page_id", "url", "record_type", "payload_bytes", "payload_digest", "refers_to"]
    schema = pa.schema([(n, pa.string() if n in ("url", "record_type", "payload_digest") else pa.int64()) for n in names])
    for batch in batches:
        rows: list[tuple] = []
        for member in batch.column(0):
            for r in records(io.BytesIO(gzip.decompress(member.as_buffer()))):
                kind, message = r.header("WARC-Type"), http(r.block)
                if kind == "revisit":
                    size, digest = int(message.header("Content-Length") or 0), (r.header("WARC-Payload-Digest") or "").removeprefix("sha256:")
                else:
                    size, digest = len(message.body), hashlib.sha256(message.body).hexdigest()
                rows.append((_page(r.header("WARC-Record-ID")), r.header("WARC-Target-URI"), kind, size, digest, _page(r.header("WARC-Refers-To"))))
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """A row per record of the archives of ``write_archives`` under path. Digests of responses are computed anew from the payloads read."""
    return spark.read.options(**TEXT).text(path).select(F.col("value").cast("binary")).mapInArrow(_parse, SCHEMA)


def deduplicate(pages: DataFrame, path: str | None = None, min_bytes: int = MIN_BYTES) -> DataFrame:
    """Write deduplicated archives (to a new folder beside the checkpoints if no path is given) and read them back."""
    spark = pages.sparkSession
    path = path or scratch(spark, "warc")
    write_archives(pages, path, min_bytes)
    return read_archives(spark, path)
