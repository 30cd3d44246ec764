"""Bytes of a payload: digests, first bytes, transfer and content encodings."""

from __future__ import annotations

import base64
import hashlib
import re
import zlib

from pyspark.sql import Column
from pyspark.sql import functions as F

from strandline.functions.binding import let

BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"


def base32(hex40: Column) -> Column:
    """Base32 of 40 hexadecimal digits, eight characters for ten digits at a time."""
    part = lambda k: F.translate(F.lpad(F.conv(F.substring(hex40, 1 + 10 * k, 10), 16, 32), 8, "0"), "0123456789ABCDEFGHIJKLMNOPQRSTUV", BASE32)
    return F.concat(*[part(k) for k in range(4)])


def sha1_base32(payload: Column) -> Column:
    return F.concat(F.lit("sha1:"), base32(F.sha1(payload)))


def digest_base32(value: Column) -> Column:
    """``sha1:`` and 40 hexadecimal digits as Base32; anything else as it is."""
    return F.when(value.rlike("^(?i)sha1:[0-9a-f]{40}$"), F.concat(F.substring(value, 1, 5), base32(F.substring(value, 6, 40)))).otherwise(value)


def digest_matches(computed: Column, declared: Column) -> Column:
    """Null if the two can't be compared because of their lengths."""
    return F.when(F.length(computed) == F.length(declared), computed == declared)


def first_bytes(payload: Column, n: int = 32) -> Column:
    """Pairs of hexadecimal digits with spaces between, padded to n bytes; null below four bytes."""
    text = F.lower(F.hex(F.substring(payload, 1, n)))
    return F.when(F.octet_length(payload) >= 4, F.regexp_replace(F.rpad(text, 2 * n, "0"), "(..)(?=.)", "$1 "))


def first_four(payload: Column) -> Column:
    return F.when(F.octet_length(payload) >= 4, F.lower(F.hex(F.substring(payload, 1, 4))))


def shingles(tokens: Column, low: int = 4, high: int = 8) -> Column:
    """All runs of low to high tokens, joined by spaces."""
    one = lambda t, n: F.when(F.size(t) >= n, F.transform(F.sequence(F.lit(1), F.size(t) - n + 1), lambda i: F.array_join(F.slice(t, i, n), " "))).otherwise(F.array().cast("array<string>"))
    return let(tokens, lambda t: F.flatten(F.array(*[one(t, n) for n in range(low, high + 1)])))


_CHUNK = re.compile(rb"^([0-9a-fA-F]{1,8})(?:;[^\r\n]*)?\r?\n")


def dechunk(body: bytes) -> bytes:
    """The content of chunked data; data that doesn't begin with a chunk's size, as it is. A cut last chunk is kept."""
    if not _CHUNK.match(body[:256]):
        return body
    out, at = [], 0
    while m := _CHUNK.match(body[at : at + 256]):
        size = int(m[1], 16)
        if not size:
            break
        begin = at + m.end()
        out.append(body[begin : begin + size])
        at = begin + size
        at += 2 if body[at : at + 2] == b"\r\n" else 1 if body[at : at + 1] == b"\n" else 0
    return b"".join(out)


def gunzip(body: bytes) -> tuple[bytes, str | None]:
    """What all gzip members hold, one after the other, and what went wrong; zeros and other bytes after the last member are passed over."""
    out: list[bytes] = []
    while True:
        engine = zlib.decompressobj(31)
        try:
            out.append(engine.decompress(body) + engine.flush())
        except zlib.error as e:
            return b"".join(out) if out else body, f"gzip: {e}"
        if not engine.eof:
            return b"".join(out), "gzip: the data is cut off"
        body = engine.unused_data.lstrip(b"\0")
        if body[:2] != b"\x1f\x8b":
            return b"".join(out), None


def decompress(body: bytes, encoding: str | None) -> tuple[bytes, str | None]:
    """Content and what went wrong. Without a hint gzip is recognised; an empty or unknown encoding leaves the bytes."""
    if encoding == "br":
        return body, "brotli can't be decoded here"
    if body and (encoding == "gzip" or (encoding is None and body[:2] == b"\x1f\x8b")):
        return gunzip(body)
    return body, None


#: Where a payload is hashed: as it is stored, without its chunks, or without its compression too.
HASH_STAGES = ("first", "after_dechunk_before_decompression", "after_dechunk_after_decompression")


def decoded(body: bytes, chunked: bool, encoding: str | None, stage: str = HASH_STAGES[1]) -> tuple[bytes, str, str | None]:
    """The content of a stored payload, the digest of the payload at the chosen stage, and what went wrong."""
    steps, error = [body], None
    steps.append(dechunk(body) if chunked else body)
    content, error = decompress(steps[1], encoding)
    steps.append(content)
    return content, "sha1:" + base64.b32encode(hashlib.sha1(steps[HASH_STAGES.index(stage)]).digest()).decode(), error


def chosen_digest(record_type: Column, computed: Column, declared: Column) -> Column:
    """The digest of a record: the header's for all but responses, if it is one of the same kind; else the computed one."""
    comparable = digest_matches(computed, declared).isNotNull()
    return F.when((record_type != "response") & F.coalesce(comparable, F.lit(False)), declared).otherwise(F.coalesce(computed, F.when(record_type == "revisit", declared)))
