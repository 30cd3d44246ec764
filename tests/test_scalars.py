"""Scalars over urls, dates, text, fields, types and payloads, on tables of cases."""

from __future__ import annotations

import datetime as dt
import gzip
import hashlib
from base64 import b32encode

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from strandline.config import DEFAULT, FieldRule, lines
from strandline.functions import dates, fields, payload, text, types, urls


def values(spark, cases, *columns):
    """The columns' values for each case, as tuples."""
    rows = spark.createDataFrame([(i, c) for i, c in enumerate(cases)], "i int, x string").select("i", *[c.alias(f"c{k}") for k, c in enumerate(columns)])
    return [tuple(r)[1:] for r in sorted(rows.collect(), key=lambda r: r[0])]


X = None


@pytest.fixture(autouse=True, scope="module")
def column(spark):
    """Columns can't be made before the session."""
    global X
    X = F.col("x")


def test_urls(spark):
    cases = ["http://User@WWW.Example.org:8080/a/b.html?x=1#f", "https://example.co.uk", "no url", None, "http://10.0.0.1/robots.txt", "http://a.b/INDEX.php"]
    got = values(spark, cases, urls.host(X), urls.path(X), urls.url_type(X), urls.scheme(X))
    assert got == [
        ("www.example.org", "/a/b.html", "normal", "http"),
        ("example.co.uk", "", "slashpage", "https"),
        ("", "", "slashpage", ""),
        (None, None, "normal", None),
        ("10.0.0.1", "/robots.txt", "robots.txt", "http"),
        ("a.b", "/INDEX.php", "slashpage", "http"),
    ]


def test_hosts(spark):
    h = urls.extract_host(X)
    cases = ["http://www7.example.org/", "http://bad_host.org/", "http://sub.example.co.uk/", "http://10.0.0.1/"]
    assert [r[0] for r in values(spark, cases, h)] == ["www7.example.org", "malformed.host", "sub.example.co.uk", "10.0.0.1"]
    hosts = ["www7.example.org", "sub.example.co.uk", "10.0.0.1", ""]
    assert values(spark, hosts, urls.canonical_host(X), urls.domain(X), urls.public_suffix(X)) == [
        ("example.org", "example.org", "org"),
        ("sub.example.co.uk", "example.co.uk", "co.uk"),
        ("10.0.0.1", "10.0.0.1", None),
        ("", "", None),
    ]
    assert values(spark, ["a.b.c"], urls.host_levels(X), urls.surt(X)) == [(["c", "b.c", "a.b.c"], "(c,b,a,")]


def test_resource_names(spark):
    cases = ["http://a/b/c.HTML?x", "http://a/b/", "http://a/x.tar.gz&y"]
    got = values(spark, cases, urls.resource_name(X), urls.extension(urls.resource_name(X)))
    assert got == [("c.HTML", "html"), ("", None), ("x.tar.gz", "gz")]


@pytest.mark.parametrize(
    ("url", "want"),
    [
        ("http://WWW.example.org/", "http://example.org/"),
        ("https://example.org:443/a/", "http://example.org/a"),
        ("http://user:pw@example.org/a?", "http://example.org/a"),
        ("http://example.org/%41b", "http://example.org/Ab"),
        ("http://example.org/a b", "http://example.org/a%20b"),
        ("http://example.org/?q=a b", "http://example.org/?q=a+b"),
        ("http://example.org/100%", "http://example.org/100%25"),
        ("http://example.org", "http://example.org/"),
    ],
)
def test_canonical_urls(url, want):
    assert urls.canonicalise(url) == want


def test_dates(spark):
    assert values(spark, ["2019-08-15T01:02", "20190815010203", "2019-08-15T01:02:03.450Z", "2019", None], dates.crawl_date(dates.wayback_time(X))) == [
        ("2019-08-15T01:02:00Z",),
        ("2019-08-15T01:02:03Z",),
        ("2019-08-15T01:02:03Z",),
        (None,),
        (None,),
    ]
    assert values(spark, ["1999-01", "0000", "99", ""], dates.year_of(X)) == [("1999",), ("unknown",), ("unknown",), ("unknown",)]
    d = dt.datetime
    cases = ["am 5. März 2001", "on 5 march 2001 at 10:20", "March 5, 2001", "2001-03-05", "31/12/1999 23:59:58", "nothing", "99/99/1999", None]
    assert [r[0] for r in values(spark, cases, dates.extract_date(X))] == [None, d(2001, 3, 5, 10, 20), d(2001, 3, 5), d(2001, 3, 5), d(1999, 12, 31, 23, 59, 58), None, None, None]


def test_text(spark):
    assert values(spark, ["a \t\n b  c", "  x"], text.trim_space(X)) == [("a\nb c",), ("x",)]
    assert values(spark, ["at SW1A 1AA and SW1A 1AA", "none"], text.postcodes(X)) == [(["SW1A 1AA"],), ([],)]
    assert values(spark, ["good good", "nothing", ""], text.mood(text.sentiment(X)), F.round(text.sentiment(X), 6)) == [("Neutral", 0.048648), ("Neutral", 0.0), ("Neutral", 0.0)]
    assert values(spark, ["Aé1!"], text.trigrams(X), text.ngrams(X, 2, 3)) == [(["aé_", "é__"], ["Aé", "é1", "1!", "Aé1", "é1!"])]
    assert values(spark, ["ab", "", None], text.trigrams(X)) == [([],), ([],), ([],)]
    assert values(spark, ["51° 30' 36\"", "-0° 6' 0,0\"", "12.5", "north"], F.round(text.degrees(X), 6)) == [(51.51,), (-0.1,), (12.5,), (None,)]


def test_fuzzy_hash_of_near_texts():
    words = " ".join(hashlib.md5(str(i).encode()).hexdigest() for i in range(200)).encode()
    one, two = text.fuzzy_hash(words), text.fuzzy_hash(words[:3000] + b"x" + words[3001:])
    assert one[0] == two[0] and 30 <= len(one[1]) <= 64
    assert sum(a == b for a, b in zip(one[1], two[1], strict=False)) > 0.8 * len(one[1])
    assert text.fuzzy_hash(b"") == (3, "", "")


def test_fields(spark):
    rule = FieldRule(max_length=4, rewrites=(("a+", "b"),))
    assert values(spark, [" aa\x07 c d", "\t", None], fields.adjust(X, rule)) == [("b c ",), (None,), (None,)]
    got = values(spark, ["x"], fields.adjust_values(F.array(F.lit("a"), F.lit("a"), F.lit(" "), F.lit("b"), F.lit("c")), FieldRule(max_values=2)))
    assert got == [(["a", "b"],)]
    assert values(spark, ["x"], fields.adjust(X, FieldRule(max_values=0))) == [(None,)]
    assert lines(DEFAULT) == sorted(lines(DEFAULT))


def test_types(spark):
    cases = ["image/png", "text/html; charset=x", "application/msword", "x/y", None]
    assert values(spark, cases, types.kind(X), types.label(X), types.bare(X)) == [
        ("image", "Image", "image/png"),
        ("html", "Web Page", "text/html"),
        ("word", "Document", "application/msword"),
        ("other", "Other", "x/y"),
        (None, None, None),
    ]
    rows = spark.createDataFrame([(b"%PDF-1.4",), (b"\x00\x00\x00\x18ftypmp42",), (b"plain",), (None,)], "b binary")
    assert [r[0] for r in rows.select(types.magic(F.col("b"))).collect()] == ["application/pdf", "video/mp4", None, None]
    assert values(spark, ["404", "abc", "1200"], types.status(X), types.status_error(X)) == [(404, None), (200, "status isn't a number: abc"), (1200, "status out of range: 1200")]


def test_payloads(spark):
    rows = spark.createDataFrame([(b"hello world",), (b"abc",), (b"",)], "b binary")
    b = F.col("b")
    got = rows.select(payload.sha1_base32(b), payload.first_bytes(b, 4), payload.first_four(b)).collect()
    want = ["sha1:" + b32encode(hashlib.sha1(x).digest()).decode() for x in (b"hello world", b"abc", b"")]
    assert [tuple(r) for r in got] == [(want[0], "68 65 6c 6c", "68656c6c"), (want[1], None, None), (want[2], None, None)]
    assert payload.dechunk(b"4\r\nwiki\r\n3;x=y\r\nped\r\n0\r\n\r\n") == b"wikiped"
    assert payload.dechunk(b"plain text") == b"plain text"
    assert payload.decompress(gzip.compress(b"x" * 100), "gzip") == (b"x" * 100, None)
    assert payload.decompress(b"\x1f\x8bbroken", None)[1].startswith("gzip")


def test_fuzzy_hash_is_that_of_the_bytes_one_by_one():
    def plain(data: bytes, size: int) -> tuple[str, str]:
        done = []
        for factor, most in ((1, 63), (2, 31)):
            h, window, c, out, roll = 0x28021967, [0] * 7, 0, "", 0
            for byte in data:
                window = [*window[1:], byte]
                c = ((c << 5) & 0xFFFFFFFF) ^ byte
                roll = (sum(window) + sum((i + 1) * x for i, x in enumerate(window)) + c) & 0xFFFFFFFF
                h = (h * 0x01000193 & 0xFFFFFFFF) ^ byte
                if roll % (factor * size) == factor * size - 1 and len(out) < most:
                    out, h = out + text._B64[h & 63], 0x28021967
            done.append(out + (text._B64[h & 63] if roll else ""))
        return tuple(done)

    rng = np.random.default_rng(1)
    cases = [b"", b"\0", b"a", b"\0" * 40, b"a" * 3000, bytes(range(256)) * 9] + [rng.integers(0, k, n).astype(np.uint8).tobytes() + b"\0" * (n % 9) for k in (2, 26, 256) for n in (1, 6, 7, 8, 50, 191, 193, 900, 2800)]
    for data in cases:
        size, one, two = text.fuzzy_hash(data)
        assert (one, two) == plain(data, size) and (size == 3 or len(one) >= 32)


def test_fuzzy_hash_takes_no_step_for_each_byte():
    import sys

    lines = 0

    def count(frame, event, _):
        nonlocal lines
        lines += event == "line"
        return count

    sys.settrace(count)
    try:
        text.fuzzy_hash(b"the quick brown fox " * 5000)
    finally:
        sys.settrace(None)
    assert lines < 2000


def test_texts_are_compared_in_runs(monkeypatch):
    from strandline.functions import trigrams

    longest, plain = [], trigrams.Profiles.distances
    monkeypatch.setattr(trigrams.Profiles, "distances", lambda self, texts: longest.append(len(texts)) or plain(self, texts))
    texts = ["the " * 100_000, "der " * 100_000, None, "", "the " * 100_000] * 2
    own = trigrams.Profiles([("en", "the", 5), ("de", "der", 9)])
    got = trigrams.scored(pa.array(texts), own).to_pylist()
    assert [r["lang"] for r in got] == ["en", "de", None, None, "en"] * 2 and max(longest) < len(texts)
