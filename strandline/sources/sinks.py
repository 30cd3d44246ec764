"""Sinks of document tables."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def write_jsonl(docs: DataFrame, path: str, gzip: bool = True, by: str | None = "source_file") -> None:
    """A line for each document, nulls included, in a folder for each archive."""
    writer = docs.write.option("ignoreNullFields", "false").option("compression", "gzip" if gzip else "none")
    (writer.partitionBy(by) if by else writer).json(path)


#: Characters that XML 1.0 can't hold in any form.
NOT_XML = r"[\x00-\x08\x0B\x0C\x0E-\x1F\x{FFFE}\x{FFFF}]"


def xml_fields(docs: DataFrame) -> Column:
    """Array of name and value: a field for each value that isn't null; one that XML can't hold, or of blanks alone, is in base64, and says so."""

    def named(name: str) -> Callable[[Column], Column]:
        field = lambda v, encoding=None: F.struct(F.lit(name).alias("_name"), F.lit(encoding).cast("string").alias("_encoding"), v.alias("_VALUE"))
        odd = lambda v: (v != "") & (F.btrim(v, F.lit(" \t\n\r")) == "") | v.rlike(NOT_XML)
        return lambda v: F.when(odd(v), field(F.base64(v.cast("binary")), "base64")).otherwise(field(v))

    parts = []
    for name, kind in docs.dtypes:
        values = F.transform(F.coalesce(F.col(name), F.array()), lambda v: v.cast("string")) if kind.startswith("array") else F.array(F.col(name).cast("string"))
        parts.append(F.transform(F.filter(values, lambda v: v.isNotNull()), named(name)))
    return F.flatten(F.array(*parts)).alias("field")


def write_xml(docs: DataFrame, path: str, gzip: bool = False, each: bool = False, by: str | None = None) -> None:
    """``add`` of ``doc`` elements; with each, a file for every document; with by, a folder for each of a column's values."""
    rows = docs.select(xml_fields(docs), *([F.col(by).alias(f"of_{by}")] if by else []))
    writer = rows.write.option("rootTag", "add").option("rowTag", "doc").option("compression", "gzip" if gzip else "none")
    writer = writer.partitionBy(f"of_{by}") if by else writer
    (writer.option("maxRecordsPerFile", 1) if each else writer).format("xml").save(path)


def read_xml(spark: SparkSession, path: str) -> DataFrame:
    """(fields): for each ``doc``, its names and values as written, empty and blank ones too."""
    rows = spark.read.schema("field array<struct<_name: string, _encoding: string, _VALUE: string>>").option("rowTag", "doc").option("ignoreSurroundingSpaces", "false").format("xml").load(path)
    value = lambda f: F.when(f["_encoding"] == "base64", F.unbase64(f["_VALUE"]).cast("string")).otherwise(F.coalesce(f["_VALUE"], F.lit("")))
    return rows.select(F.transform("field", lambda f: F.struct(f["_name"].alias("name"), value(f).alias("value"))).alias("fields"))


SINKS = {"jsonl": write_jsonl, "xml": write_xml, "parquet": lambda docs, path: docs.write.parquet(path)}


def write(docs: DataFrame, path: str | None = None, kind: str = "jsonl", endpoint: str | None = None, send: Callable | None = None, **options) -> None:
    """Exactly one of a path and an endpoint; an endpoint needs ``send``."""
    if (path is None) == (endpoint is None):
        raise ValueError("give either a path or an endpoint")
    if path is not None:
        SINKS[kind](docs, path, **options)
    elif send is None:
        raise ValueError("an endpoint needs a way to send")
    else:
        deliver(docs, send, **options)


def estimated_size(docs: DataFrame) -> Column:
    """Bytes that a document takes in memory: a sum for it, for each field and for each value."""
    total = F.lit(300)
    for name, kind in docs.dtypes:
        c = F.col(name)
        if kind.startswith("array"):
            own = F.aggregate(F.coalesce(c, F.array()), F.lit(0), lambda a, v: a + 48 + 2 * F.length(v.cast("string")))
        elif kind == "string":
            own = 48 + 2 * F.length(c)
        else:
            own = F.lit(128 if kind in ("bigint", "int") else 64)
        total = total + F.when(c.isNotNull(), 32 + len(name) + own).otherwise(0)
    return total


def deliver(docs: DataFrame, send: Callable[[list[dict]], None], max_docs: int = 500, max_bytes: int = 20 << 20) -> None:
    """Send each partition in batches: a batch goes when its estimated bytes or its documents reach the bound."""
    sized = docs.withColumn("_size", estimated_size(docs))

    def run(rows: Iterator) -> None:
        batch, size = [], 0
        for row in rows:
            doc = row.asDict(recursive=True)
            size += doc.pop("_size")
            batch.append(doc)
            if size >= max_bytes or len(batch) >= max_docs:
                send(batch)
                batch, size = [], 0
        if batch:
            send(batch)

    sized.foreachPartition(run)


def bulk_document(docs: DataFrame, id_col: str = "id") -> DataFrame:
    """(_id, body): every field as an array, an empty general type as ``other``, and the time of indexing."""
    fields = []
    for name, kind in docs.dtypes:
        if name == id_col:
            continue
        c = F.col(name)
        if name == "content_type_norm":
            c = F.coalesce(F.nullif(c, F.lit("")), F.lit("other"))
        fields.append((c if kind.startswith("array") else F.when(c.isNotNull(), F.array(c))).alias(name))
    now = F.array(F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss'Z'")).alias("index_time")
    return docs.select(F.col(id_col).alias("_id"), F.to_json(F.struct(*fields, now)).alias("body"))


def bulk_sender(post: Callable[[str], object], index: str, retries: int = 20) -> Callable[[list[dict]], None]:
    """A ``send`` that posts bulk lines for (_id, body) documents and tries again after OS errors."""
    import json

    def send(batch: list[dict]) -> None:
        lines = "".join(f"{json.dumps({'index': {'_index': index, '_id': d['_id']}})}\n{d['body']}\n" for d in batch)
        for left in range(retries, -1, -1):
            try:
                post(lines)
                return
            except OSError:
                if not left:
                    raise

    return send


def http_post(urls: list[str], content_type: str, timeout: float = 60) -> Callable[[str], bytes]:
    """A ``post`` to one of several servers of an index, one after the other; an answer that is an error raises an OS error."""
    import itertools
    import urllib.request

    turn = itertools.cycle(urls)

    def post(body: str) -> bytes:
        request = urllib.request.Request(next(turn), body.encode(), {"Content-Type": content_type}, method="POST")  # noqa: S310  the caller's own servers
        with urllib.request.urlopen(request, timeout=timeout) as answer:  # noqa: S310
            return answer.read()

    return post


def index_sender(servers: list[str], retries: int = 20) -> Callable[[list[dict]], None]:
    """A ``send`` of (_id, body) documents to the bulk interface of ``http://host:port/index`` servers; a batch with a refused document is an error."""
    import json

    ends = [endpoint(u) for u in servers]

    def post(lines: str) -> None:
        answer = json.loads(http_post([f"{e.scheme}://{e.host}:{e.port}/_bulk" for e in ends], "application/x-ndjson")(lines))
        if answer.get("errors"):
            raise OSError(f"refused: {answer}"[:500])

    return bulk_sender(post, ends[0].index, retries)


def update_sender(servers: list[str], commit_within: int = 60_000, retries: int = 20) -> Callable[[list[dict]], None]:
    """A ``send`` of documents, as JSON, to the update interface of ``http://host:port/collection`` servers; nulls are left out."""
    import json

    def send(batch: list[dict]) -> None:
        lines = json.dumps([{k: v for k, v in d.items() if v is not None} for d in batch], default=str)
        post = http_post([f"{u.rstrip('/')}/update?commitWithin={commit_within}" for u in servers], "application/json")
        for left in range(retries, -1, -1):
            try:
                post(lines)
                return
            except OSError:
                if not left:
                    raise

    return send


@dataclass(frozen=True)
class Endpoint:
    scheme: str
    host: str
    port: int
    index: str


def endpoint(url: str) -> Endpoint:
    """Parts of ``http(s)://host[:port]/index``; port 80 if it isn't given."""
    m = re.fullmatch(r"(https?)://([^/:?#\s]+)(?::(\d+))?/([^/?#\s]+)(?:[/?#].*)?", url or "")
    if not m or (m[3] and not 0 < int(m[3]) < 65536):
        raise ValueError(f"not an endpoint: {url}")
    return Endpoint(m[1], m[2], int(m[3] or 80), m[4])


def format_triple(served: Column, detected: Column, signature: Column) -> Column:
    return F.concat_ws("\t", *[F.coalesce(c, F.lit("")) for c in (served, detected, signature)])


def face_line(faces: Column, prefix: str, url: Column, date: Column) -> Column:
    """url, date and the sorted matches of a prefix."""
    own = F.array_sort(F.filter(faces, lambda f: f.startswith(prefix)))
    return F.when(F.size(own) > 0, F.concat_ws("\t", url, date, F.array_join(own, " ")))
