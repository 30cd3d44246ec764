"""The capture plan with rule tables, suffix rules, settings files and the command line."""

from __future__ import annotations

import glob
import json

import pytest
from pyspark.sql import functions as F

from strandline import __main__ as cli
from strandline import config
from strandline.operators import annotate
from strandline.operators.suffixes import suffixes
from strandline.plans.documents import Tables, documents
from strandline.sources import captures, rules
from strandline.sources.warc import http
from tests.test_captures import PAGE, record

GEO = b'<html><head><meta name="generator" content="Tool 1"><meta name="geo.position" content="51.5;-0.1"><meta name="date" content="2019-08-01"></head><body><p>the quick fox at SW1A 1AA</p><a href="http://a.b.co.jp/x">j</a></body></html>'


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    out = tmp_path_factory.mktemp("plan")
    rows = [
        record("response", "http://www.example.org/", "2019-08-15T01:02:03Z", PAGE),
        record("response", "http://shop.example.com.au/geo", "2019-08-15T01:02:04Z", GEO),
        record("response", "http://bad.example.org/", "2019-08-15T01:02:05Z", b"<html>x", 2001),
        record("response", "http://gone.example.org/private/1", "2019-08-15T01:02:06Z", b"<html>y"),
        record("response", "http://to.example.org/", "2019-08-15T01:02:07Z", b"<html>z", 200, "Location: ../next?a=1\r\n"),
        record("response", "http://img.example.org/i.png", "2019-08-15T01:02:08Z", b"\x89PNG\r\n\x1a\n" + b"\0\0\0\rIHDR" + (7).to_bytes(4, "big") + (5).to_bytes(4, "big")),
    ]
    (out / "a.warc").write_bytes(b"".join(rows))
    return out


def test_tables_reach_the_documents(spark, folder):
    given = spark.createDataFrame([("subdomains", "example.org", "C", ["C"], ["s"])], "scope string, key string, collection string, collections array<string>, subject array<string>")
    ranges = spark.createDataFrame([("C", None, None)], "collection string, start timestamp, end timestamp")
    profiles = spark.createDataFrame([("en", "the", 5), ("en", "he_", 5), ("de", "der", 9)], "lang string, ngram string, n long")
    tables = Tables(
        spark.createDataFrame([("gone.example.org/private",)], "prefix string"),
        given,
        ranges,
        spark.createDataFrame([("http://(org,example,www,",)], "prefix string"),
        profiles,
        spark.createDataFrame([("com.au",), ("co.jp",), ("org",)], "rule string"),
        spark.createDataFrame([("SW1A", 51.5, -0.14)], "district string, lat double, lon double"),
    )
    docs = documents(captures.read(spark, str(folder)), config.load({"images": True, "linked_resources": True}), tables=tables)
    rows = {r.url: r for r in docs.collect()}
    assert not {"payload", "_ts", "payload_digest"} & set(docs.columns) and len(rows) == 5
    page, geo, bad, to, image = (rows[u] for u in ("http://www.example.org/", "http://shop.example.com.au/geo", "http://bad.example.org/", "http://to.example.org/", "http://img.example.org/i.png"))
    assert (page.collections, page.access_terms, page.domain) == (["C"], "OA", "example.org") and page.links_images == ["http://www.example.org/i.png"]
    assert (geo.domain, geo.public_suffix, geo.links_domains, geo.links_public_suffixes) == ("example.com.au", "com.au", ["b.co.jp"], ["co.jp"])
    assert (geo.content_language, geo.generator, geo.location, geo.last_modified) == ("en", ["Tool 1"], "51.5,-0.1", "2019-08-01T00:00:00Z")
    assert (geo.locations, geo.access_terms, geo.collections) == (["51.5,-0.14"], "RRO", None)
    assert bad.content_type_served is None and bad.server is None and len(bad.parse_error) == 1
    assert to.redirect_to_norm == "http://to.example.org/next?a=1" and to.content_type_served == "text/html"
    assert (image.image_height, image.image_width, image.image_size) == (5, 7, 35)


def test_links_are_normalised_on_demand(spark, folder):
    docs = documents(captures.read(spark, str(folder)), config.load({"normalise_links": True}))
    page = docs.where("url = 'http://www.example.org/'").first()
    assert page.links == ["http://example.org/x%20y", "http://other.co.uk/"] and page.url_norm == "http://example.org/"


def test_suffix_rules(spark, tmp_path):
    (tmp_path / "list.dat").write_text("// comment\n\ncom\njp\nco.jp // more\n*.ck\n!www.ck\n")
    own = rules.suffix_rules(spark, str(tmp_path / "list.dat"))
    want = {
        "a.b.com": ("com", "b.com"), "x.y.co.jp": ("co.jp", "y.co.jp"), "y.jp": ("jp", "y.jp"), "co.jp": ("co.jp", "co.jp"), "a.b.c.ck": ("c.ck", "b.c.ck"), "b.ck": ("b.ck", "b.ck"),
        "x.www.ck": ("ck", "www.ck"), "a.unknown": ("unknown", "a.unknown"), "a.b.co.uk": ("co.uk", "b.co.uk"), "10.0.0.1": (None, "10.0.0.1"), "single": (None, "single"),
    }
    hosts = spark.createDataFrame([(h,) for h in [*want, "A.B.com", None]], "host string")
    assert {r.host: (r.public_suffix, r.domain) for r in suffixes(hosts, own).collect()} == want


def test_updates_take_prefixes_and_dates_add_up(spark):
    docs = spark.createDataFrame([("1", "http://a.org/x", "f"), ("2", "http://a.organ/", "f"), ("3", "http://b.org/", "f")], "id string, url string, source_file string")
    given = spark.createDataFrame([("root", "http://a.org", "A", ["A"], ["s"]), ("resource", "http://b.org/", "B", ["B"], ["t"])], "scope string, key string, collection string, collections array<string>, subject array<string>")
    assert sorted((r.id, r.scope) for r in annotate.prefix_updates(docs, given).collect()) == [("1", "root"), ("2", "root"), ("3", "resource")]
    dates = spark.createDataFrame([("b", ["c", "a", "b"]), ("b", None)], "now string, before array<string>")
    assert [r.d for r in dates.select(annotate.merged_dates(F.col("now"), F.col("before")).alias("d")).collect()] == [["a", "b", "c"], ["b"]]


def test_settings_of_a_file(tmp_path):
    (tmp_path / "c.toml").write_text('profile = "dataset"\nresponse_codes = ["2", "30"]\n[fields.url]\nmax_length = 10\n')
    own = config.read(str(tmp_path / "c.toml"))
    assert own.response_codes == ("2", "30") and own.first_bytes and own.rule("url").max_length == 10 and own.rule("content") == config.DEFAULT.rule("content")
    with pytest.raises(ValueError, match="no such setting: nonsense"):
        config.load({"nonsense": 1})


def test_command_line(spark, folder, tmp_path, capsys):
    cli.main(["--print-config"])
    assert "language = True" in capsys.readouterr().out
    (tmp_path / "not.txt").write_text("gone.example.org\n")
    cli.main([str(tmp_path / "out"), str(folder / "a.warc"), "--exclusions", str(tmp_path / "not.txt")], spark)
    lines = [json.loads(x) for f in glob.glob(str(tmp_path / "out/*/*.json.gz")) for x in __import__("gzip").open(f)]
    assert {r["url"] for r in lines} == {r.url for r in documents(captures.read(spark, str(folder))).collect()} - {"http://gone.example.org/private/1"}
    with pytest.raises(SystemExit):
        cli.main([])


def test_messages():
    assert http(b"HTTP/1.1 204\r\nA: b\r\n c\r\nbroken\r\n\r\nbody").headers == [("A", "b c")] and http(b"plain").status is None
