"""Content types: the general kind, the choice between sources, magic bytes, status and header checks."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

#: Kind, label and pattern, the first that fits.
KINDS = (
    ("image", "Image", r"^image/.*$"),
    ("audio", "Audio", r"^(audio/.*|application/vnd\.rn-realaudio)$"),
    ("video", "Video", r"^(video/.*|application/mp4|application/vnd\.rn-realmedia)$"),
    ("html", "Web Page", r"^(text/htm|application/xhtml).*$"),
    ("pdf", "Document", r"^application/pdf.*$"),
    ("word", "Document", r"^.*word$"),
    ("excel", "Data", r"^.*excel$"),
    ("powerpoint", "Presentation", r"^.*powerpoint$"),
    ("text", "Document", r"^text/plain.*$"),
)

#: Offset, bytes in hex and type.
MAGIC = (
    (0, "25504446", "application/pdf"),
    (0, "89504e470d0a1a0a", "image/png"),
    (0, "ffd8ff", "image/jpeg"),
    (0, "474946383761", "image/gif"),
    (0, "474946383961", "image/gif"),
    (0, "504b0304", "application/zip"),
    (0, "1f8b", "application/gzip"),
    (0, "d0cf11e0a1b11ae1", "application/x-tika-msoffice"),
    (0, "7b5c727466", "application/rtf"),
    (4, "66747970", "video/mp4"),
    (0, "4f676753", "audio/ogg"),
    (0, "494433", "audio/mpeg"),
    (0, "424d", "image/bmp"),
    (0, "49492a00", "image/tiff"),
    (0, "4d4d002a", "image/tiff"),
    (0, "52494646", "application/x-riff"),
    (0, "3c3f786d6c", "application/xml"),
)


def bare(content_type: Column) -> Column:
    return F.regexp_replace(content_type, r"(?s);.*$", "")


def _ladder(content_type: Column, at: int, other: str) -> Column:
    out = F.lit(other)
    for row in reversed(KINDS):
        out = F.when(content_type.rlike(row[2]), row[at]).otherwise(out)
    return F.when(content_type.isNotNull(), out)


def kind(content_type: Column) -> Column:
    return _ladder(content_type, 0, "other")


def label(content_type: Column) -> Column:
    return _ladder(content_type, 1, "Other")


def has_script_type(content_type: Column) -> Column:
    """Types whose text isn't kept."""
    return content_type.startswith("application/javascript") | content_type.startswith("text/javascript") | content_type.startswith("text/css")


def magic(payload: Column) -> Column:
    """Type by the first bytes of a binary, else null."""
    head = F.lower(F.hex(F.substring(payload, 1, 64)))
    out = F.lit(None).cast("string")
    for offset, pattern, name in reversed(MAGIC):
        out = F.when(F.substring(head, 2 * offset + 1, len(pattern)) == pattern, name).otherwise(out)
    return out


def choose(detected: Column, signature: Column, identified: Column, served: Column, header: Column, length: Column, revisit: Column) -> Column:
    """The type of a record: detection, refined by a signature of the same type or replaced if it says nothing; then what was declared."""
    vague = detected.isNull() | (bare(detected) == "application/octet-stream")
    finer = (bare(detected) == bare(signature)) & (F.length(signature) > F.length(detected))
    best = F.when(vague | finer, signature).otherwise(detected)
    best = F.when(best.isNull() | (best == "application/octet-stream"), F.coalesce(identified, served, header, best)).otherwise(best)
    return F.when((length == 0) & ~revisit, "application/x-empty").otherwise(best)


def status(value: Column) -> Column:
    """HTTP status as a number; 200 if it is none."""
    return F.coalesce(F.expr("try_cast(x as int)") if isinstance(value, str) else value.try_cast("int"), F.lit(200))


def status_error(value: Column) -> Column:
    """What is wrong with a status, else null; no header of such a record is taken."""
    n = value.try_cast("int")
    return F.when(n.isNull(), F.concat(F.lit("status isn't a number: "), value)).when(~n.between(0, 1000), F.concat(F.lit("status out of range: "), value))


def header(headers: Column, name: str) -> Column:
    """First value of a header in an array of (name, value), whatever its case."""
    return F.get(F.filter(headers, lambda h: F.lower(h["name"]) == name.lower()), F.lit(0))["value"]


@F.pandas_udf(StringType())
def root_namespace(payload):
    """``namespace#name`` of the first element of an XML document, in lower case; null without a namespace or without XML."""
    import io
    from xml.etree import ElementTree

    import pandas as pd

    def root(data: bytes | None) -> str | None:
        if data is None:
            return None
        try:
            _, element = next(ElementTree.iterparse(io.BytesIO(data), ("start",)))
        except (ElementTree.ParseError, StopIteration, LookupError, ValueError):
            return None
        namespace, closed, local = element.tag.removeprefix("{").partition("}")
        return f"{namespace}#{local}".lower() if closed and namespace.strip() else None

    return pd.Series([root(p) for p in payload], dtype=object)
