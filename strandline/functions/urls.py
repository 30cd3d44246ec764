"""Scalars over urls, hosts and resource names. All are native columns but ``canonical_url``, which works on bytes."""

from __future__ import annotations

import re
from urllib.parse import urljoin

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from strandline.functions.binding import let

MALFORMED = "malformed.host"
IPV4 = r"^\d{1,3}(\.\d{1,3}){3}$"
LABEL = r"[\p{L}0-9](?:[\p{L}0-9-]{0,61}[\p{L}0-9])?"


def strip_brackets(value: Column) -> Column:
    """Without one pair of angle brackets around it; a single bracket stays."""
    return F.regexp_replace(value, r"(?s)^<(.*)>$", "$1")


def scheme(url: Column) -> Column:
    return F.lower(F.regexp_extract(url, r"^([A-Za-z][A-Za-z0-9+.-]*)://", 1))


def authority(url: Column) -> Column:
    return F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1)


def host(url: Column) -> Column:
    """Lower-case host without user and port; empty if there is none."""
    return F.lower(F.regexp_replace(F.regexp_replace(authority(url), r"^.*@", ""), r":\d*$", ""))


def extract_host(url: Column) -> Column:
    """The host if each label and the whole are well formed, else a marker."""
    h = F.regexp_replace(F.regexp_replace(authority(url), r"^.*@", ""), r":\d*$", "")
    good = h.rlike(rf"^{LABEL}(\.{LABEL})*\.?$") & (F.length(h) <= 255)
    return F.when(good, F.lower(h)).otherwise(MALFORMED)


def path(url: Column) -> Column:
    return F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)", 1)


def url_type(url: Column) -> Column:
    p = F.lower(path(url))
    return F.when(p.rlike(r"^/?$|^/index\.[a-z]+$"), "slashpage").when(p == "/robots.txt", "robots.txt").otherwise("normal")


def resource_name(url: Column) -> Column:
    """What follows the last slash of the whole url, up to a question mark or ampersand."""
    return F.regexp_replace(F.substring_index(url, "/", -1), r"(?s)[?&].*$", "")


def extension(name: Column) -> Column:
    """Letters and digits after the last dot, in lower case; null without a dot."""
    return F.when(F.instr(name, ".") > 0, F.regexp_replace(F.lower(F.substring_index(name, ".", -1)), "[^0-9a-z]", ""))


def record_id(url: Column, digits: Column) -> Column:
    """Timestamp digits, a slash, and the base64 of the url's MD5."""
    return F.concat(digits, F.lit("/"), F.base64(F.unhex(F.md5(url.cast("binary")))))


def remove_port(url: Column) -> Column:
    """http(s) urls without port; user-info before a port goes with it."""
    return F.regexp_replace(url, r"(?i)^(https?://)(?:[^/?#@]*@)?([^/?#:@]*):\d+", "$1$2")


def canonical_host(h: Column) -> Column:
    return F.regexp_replace(F.lower(h), r"^(www\d*|ww2|ww)\.", "")


def labels(h: Column) -> Column:
    """The labels of a host; none for an address or an empty host."""
    return F.when((h == "") | h.rlike(IPV4) | h.isNull() | (h == MALFORMED), F.array().cast("array<string>")).otherwise(F.split(F.lower(h), r"\."))


def host_levels(h: Column) -> Column:
    """From the top level down: [c, b.c, a.b.c]."""
    each = lambda parts: F.transform(F.sequence(F.lit(1), F.size(parts)), lambda i: F.array_join(F.slice(parts, -i, i), "."))
    return let(labels(h), lambda parts: F.when(F.size(parts) == 0, F.array().cast("array<string>")).otherwise(each(parts)))


def surt(h: Column) -> Column:
    """Reversed, comma-separated host: (c,b,a,"""
    return F.concat(F.lit("("), F.array_join(F.reverse(F.split(F.lower(h), r"\.")), ","), F.lit(","))


def host_surts(h: Column) -> Column:
    return F.transform(host_levels(h), surt)


def last_labels(h: Column, n: int) -> Column:
    parts = labels(h)
    return F.when(F.size(parts) >= n, F.array_join(F.slice(parts, -n, n), "."))


def public_suffix(h: Column, suffixes: frozenset[str] = frozenset()) -> Column:
    """Two labels under .uk; else the longest known suffix, or the last label where none is known; null for addresses and single labels."""
    parts = labels(h)
    known = F.filter(host_levels(h), lambda x: x.isin(*suffixes)) if suffixes else F.array().cast("array<string>")
    listed = F.when(F.size(known) > 0, F.element_at(known, -1)).otherwise(F.element_at(parts, -1))
    return F.when(F.size(parts) < 2, None).when(F.element_at(parts, -1) == "uk", last_labels(h, 2)).otherwise(listed)


def domain(h: Column, suffixes: frozenset[str] = frozenset()) -> Column:
    """Three labels under .uk; else one label more than the public suffix; the host itself where that can't be told."""
    parts = labels(h)
    n = F.size(F.split(public_suffix(h, suffixes), r"\.")) + 1
    below = F.when(F.size(parts) >= n, F.array_join(F.slice(parts, -n, n), "."))
    return F.when(F.size(parts) == 0, h).when(F.element_at(parts, -1) == "uk", F.coalesce(last_labels(h, 3), h)).otherwise(F.coalesce(below, h))


def canonical_ascii(url: Column) -> Column:
    """Native canonical form of urls in printable ASCII without escapes, spaces and backslashes."""
    u = F.regexp_replace(F.lower(url), r"^(https?://)[^/?#@]*@", "$1")
    u = F.regexp_replace(F.regexp_replace(u, SESSION, ""), r"[?&]+$", "")
    u = F.regexp_replace(F.regexp_replace(u, "^https://", "http://"), r"^([a-z]+://)(?:www[0-9]*|ww2|ww)\.(.+)$", "$1$2")
    u = F.regexp_replace(u, "/+$", "")
    return F.regexp_replace(F.regexp_replace(u, r"^(http://[^/]+)$", "$1/"), r"^(http://[^/?#:]*):\d+", "$1")


SESSION = r"(?:(?:;jsessionid=[0-9a-z.]{24,40})|(?:(?<=[?&])(?:jsessionid|phpsessid|sid)=[0-9a-z]{32}&?)|(?:(?<=[?&])aspsessionid[a-z]{8}=[a-z]{24}&?))"
_STRAY = re.compile(rb"%(?![0-9a-fA-F]{2})")
_HIGH = re.compile(rb"%([89a-fA-F][0-9a-fA-F])")
_TOKEN = re.compile(rb"%[0-9a-fA-F]{2}|[\xc0-\xdf][\x80-\xbf]|[\xe0-\xef][\x80-\xbf]{2}|[\xf0-\xf7][\x80-\xbf]{3}|.", re.S)
_KEPT = b" %\\#"


def canonicalise(url: str, high_order: bool = True, unambiguous: bool = True) -> str:
    """One form for urls of one resource: case, user, session ids, scheme, www, escapes, final slashes and port.

    Two-byte UTF-8 stays raw if high_order; longer sequences and stray bytes are escaped. If unambiguous, escapes of ASCII
    that needn't be escaped are resolved and the www prefix goes.
    """
    u = re.sub(r"^(https?://)[^/?#@]*@", r"\1", url.lower())
    u = re.sub(r"[?&]+$", "", re.sub(SESSION, "", u))
    u = "http://" + u[8:] if u.startswith("https://") else u
    if unambiguous:
        u = re.sub(r"^([a-z]+://)(?:www[0-9]*|ww2|ww)\.(.+)$", r"\1\2", u, flags=re.S)
    raw = _HIGH.sub(lambda m: bytes([int(m[1], 16)]), _STRAY.sub(b"%25", u.encode("utf-8", "surrogatepass")))
    out, query = bytearray(), False
    for m in _TOKEN.finditer(raw):
        t = m[0]
        query |= t == b"?"
        if t[:1] == b"%" and len(t) == 3:
            code = int(t[1:], 16)
            if query and code == 32:
                out += b"+"
            elif code in _KEPT or not unambiguous:
                out += b"%%%02x" % code
            else:
                out.append(code)
        elif query and t == b" ":
            out += b"+"
        elif len(t) == 1 and t[0] < 128:
            out += b"%%%02x" % t[0] if t in (b" ", b"\\") else t
        elif len(t) == 2 and high_order:
            out += t
        else:
            out += b"".join(b"%%%02x" % b for b in t)
    u = out.decode("utf-8", "replace").rstrip("/")
    if re.fullmatch(r"https?://[^/]+", u):
        u += "/"
    return re.sub(r"^(https?://[^/?#:]*):\d+", r"\1", u)


def resolve(base: str, link: str, normalise: bool = True) -> str | None:
    """A link made absolute; null if it can't be."""
    try:
        out = urljoin(base, link)
    except ValueError:
        return None
    return canonicalise(out) if normalise else out


@F.pandas_udf(StringType())
def resolved_url(base, link):
    """Links made absolute and canonical; null where there is none."""
    return pd.Series([None if b is None or x is None else resolve(b, x) for b, x in zip(base, link, strict=True)], dtype=object)


@F.pandas_udf(StringType())
def canonical_url(url):
    return url.map(lambda u: None if u is None else canonicalise(u))
