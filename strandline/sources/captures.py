"""Capture records as DataFrames, from archives on any file system that Spark reads."""

from __future__ import annotations

import io
import itertools
import os
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandline.functions import payload as P
from strandline.functions import urls
from strandline.sources.warc import WarcRecord, all_records, http, plain

SCHEMA = (
    "source_file string, source_file_path string, offset bigint, record_type string, url string, warc_date string, "
    "warc_headers map<string,string>, http_status string, http_headers array<struct<name:string,value:string>>, "
    "payload binary, payload_digest string, truncated boolean, parse_error array<string>"
)
_ARROW = pa.schema(
    [
        ("source_file", pa.string()),
        ("source_file_path", pa.string()),
        ("offset", pa.int64()),
        ("record_type", pa.string()),
        ("url", pa.string()),
        ("warc_date", pa.string()),
        ("warc_headers", pa.map_(pa.string(), pa.string())),
        ("http_status", pa.string()),
        ("http_headers", pa.list_(pa.struct([("name", pa.string()), ("value", pa.string())]))),
        ("payload", pa.binary()),
        ("payload_digest", pa.string()),
        ("truncated", pa.bool_()),
        ("parse_error", pa.list_(pa.string())),
    ]
)
#: Payload bytes that go into one batch.
BATCH = 16 << 20


def _strip(v: str | None) -> str | None:
    return v[1:-1] if v and v.startswith("<") and v.endswith(">") else v


def record_row(r: WarcRecord, name: str, path: str, decode: bool, stage: str) -> dict:
    """The row of a record: its whole payload, and the payload's digest at the stage."""
    kind, errors = r.header("WARC-Type"), []
    status, headers, body, chunked, encoding = None, [], r.block, False, ""
    if kind in ("response", "revisit", "arc"):
        message = http(r.block)
        status, headers, body = message.status, message.headers, message.body
        chunked, encoding = "chunked" in (message.header("Transfer-Encoding") or "").lower(), (message.header("Content-Encoding") or "").lower() or None
    content, digest, error = P.decoded(body, chunked, encoding, stage)
    return {
        "source_file": name,
        "source_file_path": path,
        "offset": r.offset,
        "record_type": kind,
        "url": _strip(r.header("WARC-Target-URI")),
        "warc_date": r.header("WARC-Date"),
        "warc_headers": list(dict(r.headers).items()),
        "http_status": status,
        "http_headers": [{"name": k, "value": v} for k, v in headers],
        "payload": content if decode else body,
        "payload_digest": digest,
        "truncated": r.truncated,
        "parse_error": errors + ([error] if error and decode else []),
    }


def record_rows(stream: io.BufferedReader, path: str, decode: bool, stage: str) -> Iterator[dict]:
    """A row for each record of an archive's plain bytes; a file that breaks off ends in a row that says so."""
    name, at, error = os.path.basename(path), 0, None
    try:
        for r in all_records(stream, name):
            at = r.offset
            yield record_row(r, name, path, decode, stage)
        error = getattr(stream.raw, "error", None)
    except (OSError, EOFError, ValueError) as e:
        error = f"{type(e).__name__}: {e}"
    if error:
        yield dict.fromkeys(_ARROW.names) | {"source_file": name, "source_file_path": path, "offset": at, "record_type": "_corrupt", "parse_error": [error]}


def _batched(rows: Iterator[dict]) -> Iterator[pa.RecordBatch]:
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += len(row["payload"] or b"") + 1000
        if size > BATCH:
            yield pa.RecordBatch.from_pylist(held, _ARROW)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_pylist(held, _ARROW)


def _read(decode: bool, stage: str):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            for path, content in zip(batch.column("path"), batch.column("content"), strict=True):
                yield from record_rows(plain(pa.BufferReader(content.as_buffer())), path.as_py(), decode, stage)

    return lambda batches: _batched(rows(batches))


class _Pieces(io.RawIOBase):
    """The plain bytes of one archive, from its pieces: what Spark found between two separators."""

    def __init__(self, pieces: Iterator[bytes]):
        self.pieces, self.left = pieces, memoryview(b"")

    def readable(self) -> bool:
        return True

    def readinto(self, into) -> int:
        while not self.left:
            piece = next(self.pieces, None)
            if piece is None:
                return 0
            self.left = memoryview(piece).cast("B")
        n = min(len(into), len(self.left))
        into[:n], self.left = self.left[:n], self.left[n:]
        return n


def _stream(decode: bool, stage: str, separator: bytes):
    """Rows (path, piece), in the order of each file, to records; no more than a record is held."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        found = ((p, v.as_buffer()) for b in batches for p, v in zip(b.column("path").to_pylist(), b.column("piece"), strict=True))
        for path, own in itertools.groupby(found, key=lambda x: x[0]):
            pieces = (part for i, (_, piece) in enumerate(own) for part in ((separator, piece) if i else (piece,)))
            yield from record_rows(io.BufferedReader(_Pieces(pieces), 1 << 20), path, decode, stage)

    return lambda batches: _batched(rows(batches))


def parse_files(files: DataFrame, decode: bool = True, stage: str = P.HASH_STAGES[1]) -> DataFrame:
    """Records of files (path, content); works on batch and streaming frames."""
    return files.select("path", "content").mapInArrow(_read(decode, stage), SCHEMA)


def parse_large(spark: SparkSession, paths: list[str], decode: bool = True, stage: str = P.HASH_STAGES[1]) -> DataFrame:
    """Records of gzipped archives of any size, each streamed by one task, with Spark's own decompression.

    A task holds a record at a time. Damaged compression ends an archive there; the record it ends in is marked as truncated.
    """
    lines = spark.read.option("lineSep", SEPARATOR).option("ignoreCorruptFiles", True).text(paths)
    pieces = lines.select(F.col("_metadata.file_path").alias("path"), F.col("value").cast("binary").alias("piece"))
    return pieces.mapInArrow(_stream(decode, stage, SEPARATOR.encode()), SCHEMA)


#: What no record is without; where it stands inside of a payload, pieces are joined again.
SEPARATOR = "Content-Length"


def read(spark: SparkSession, path: str | list[str], decode: bool = True, stage: str = P.HASH_STAGES[1], whole: int = 512 << 20) -> DataFrame:
    """Records of the archives under path. With decode, transfer and content encodings are taken off.

    Archives of up to ``whole`` bytes are read as one value each; larger ones, if gzipped, record by record. Plain archives,
    which have no compression to lose, are read as one value up to the 2 GB that Spark allows.
    """
    files = spark.read.format("binaryFile").load(path)
    large = F.lower("path").endswith(".gz") & (F.col("length") > whole)
    paths = [r["path"] for r in files.where(F.col("length") > whole).where(large).select("path").collect()]  # a path for each large archive
    if not paths:
        return parse_files(files, decode, stage)
    return parse_files(files.where(~large), decode, stage).union(parse_large(spark, paths, decode, stage))


def from_pages(pages: DataFrame, date: str = "2024-01-01T00:00:00Z") -> DataFrame:
    """Records of a table (url, html), each as if it were a response."""
    return pages.select(
        F.lit("pages").alias("source_file"),
        F.lit("pages").alias("source_file_path"),
        F.col("page_id").alias("offset"),
        F.lit("response").alias("record_type"),
        urls.strip_brackets(F.col("url")).alias("url"),
        F.lit(date).alias("warc_date"),
        F.create_map().cast("map<string,string>").alias("warc_headers"),
        F.lit("200").alias("http_status"),
        F.array(F.struct(F.lit("Content-Type").alias("name"), F.lit("text/html; charset=utf-8").alias("value"))).alias("http_headers"),
        F.col("html").cast("binary").alias("payload"),
        P.sha1_base32(F.col("html").cast("binary")).alias("payload_digest"),
        F.lit(False).alias("truncated"),
        F.array().cast("array<string>").alias("parse_error"),
    )
