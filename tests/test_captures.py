"""Archives to records to documents, annotation files, sinks, streams, images and enrichment."""

from __future__ import annotations

import base64
import glob
import gzip
import hashlib
import io
import json

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from strandline.config import DATASET, DEFAULT
from strandline.functions import batches, html, images, payload
from strandline.operators import annotate, names, records, search, summaries
from strandline.plans import catalogue
from strandline.plans import documents as plans
from strandline.plans.documents import documents
from strandline.plans.enrich import enrich
from strandline.sources import captures, rules, sinks, warc
from strandline.streaming import captures as streams

PAGE = b'<html lang="en"><head><title> A page </title><link rel="canonical" href="/c"></head><body><p>First <b>words</b></p><a href="/x y">x</a><a href="http://www.other.co.uk/">o</a><img src="i.png"><script>var p = "</p>";</script></body></html>'


def record(kind: str, url: str, date: str, body: bytes, status: int = 200, extra: str = "") -> bytes:
    block = f"HTTP/1.1 {status} OK\r\nContent-Type: text/html\r\nServer: test\r\n{extra}\r\n".encode() + body if kind == "response" else body
    head = f"WARC/1.0\r\nWARC-Type: {kind}\r\nWARC-Target-URI: {url}\r\nWARC-Date: {date}\r\nWARC-Record-ID: <urn:uuid:1>\r\nContent-Length: {len(block)}\r\n\r\n".encode()
    return head + block + b"\r\n\r\n"


ARCHIVE = [
    record("warcinfo", "about:", "2019-08-15T01:02:03Z", b"software: test\r\n"),
    record("response", "http://www.example.org/", "2019-08-15T01:02", PAGE),
    record("request", "http://www.example.org/", "2019-08-15T01:02:03Z", b"GET / HTTP/1.1\r\n\r\n"),
    record("response", "http://www.example.org/missing", "2019-08-15T01:02:05Z", b"gone", 404),
    record("resource", "http://example.org/plain.pdf", "2019-08-15T01:02:06Z", b"%PDF-1.4 x"),
    record("response", "ftp://example.org/f", "2019-08-15T01:02:07Z", b"x"),
    record("response", "http://example.org/chunks", "2019-08-15T01:02:08Z", b"5\r\n<html\r\n1\r\n>\r\n0\r\n\r\n", extra="Transfer-Encoding: chunked\r\n"),
]


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    out = tmp_path_factory.mktemp("archives")
    (out / "a.warc").write_bytes(b"".join(ARCHIVE))
    (out / "b.warc.gz").write_bytes(b"".join(gzip.compress(r) for r in ARCHIVE[:2]))
    (out / "c.arc").write_bytes(b"filedesc://c.arc 0.0.0.0 20190815 text/plain 2\nxx\nhttp://old.example.org/a 10.0.0.1 20190815010203 text/html 26\nHTTP/1.0 200 OK\r\n\r\n<p>old\n")
    return str(out)


def test_framing():
    got = list(warc.records(warc.plain(io.BytesIO(b"junk\r\n" + b"".join(ARCHIVE)))))
    assert [r.header("warc-type") for r in got] == ["warcinfo", "response", "request", "response", "resource", "response", "response"]
    assert not any(r.truncated for r in got)
    cut = list(warc.records(io.BytesIO(ARCHIVE[1][:-200])))
    assert cut[0].truncated
    assert list(warc.records(io.BytesIO(b""))) == []
    padded = warc.plain(io.BytesIO(b"".join(gzip.compress(r) + b"\0" * 3 for r in ARCHIVE)))
    assert len(list(warc.records(padded))) == len(ARCHIVE) and padded.raw.error is None


def test_records(spark, folder):
    rows = captures.read(spark, folder).collect()
    assert sorted({r.source_file for r in rows}) == ["a.warc", "b.warc.gz", "c.arc"]
    chunked = next(r for r in rows if r.url and r.url.endswith("chunks"))
    assert bytes(chunked.payload) == b"<html>" and chunked.http_status == "200"
    old = next(r for r in rows if r.record_type == "arc")
    assert old.url == "http://old.example.org/a" and old.warc_date == "20190815010203"


def test_broken_archive(spark, tmp_path):
    (tmp_path / "x.warc.gz").write_bytes(gzip.compress(ARCHIVE[1])[:-30])
    rows = captures.read(spark, str(tmp_path)).collect()
    assert [r.record_type for r in rows] == ["response", "_corrupt"] and rows[0].truncated and rows[-1].parse_error


def test_archives_read_whole_and_in_pieces_are_the_same(spark, tmp_path):
    nested = record("resource", "http://example.org/nested", "2019-08-15T01:02:06Z", b"Content-Length: 5\r\n\r\nContent-Length" * 5)
    (tmp_path / "a.warc.gz").write_bytes(b"".join(gzip.compress(r) for r in (ARCHIVE + [nested]) * 30))
    (tmp_path / "b.warc").write_bytes(b"".join(ARCHIVE))
    one, two = captures.read(spark, str(tmp_path)), captures.read(spark, str(tmp_path), whole=0)
    assert sorted(map(repr, one.collect())) == sorted(map(repr, two.collect())) and one.count() == 247


def test_decoding_and_digests():
    stored = b"6\r\n" + (body := gzip.compress(b"one") + gzip.compress(b"two"))[:6] + b"\r\n" + f"{len(body) - 6:x}\r\n".encode() + body[6:] + b"\r\n0\r\n\r\n"
    digest = lambda b: "sha1:" + base64.b32encode(hashlib.sha1(b).digest()).decode()
    for stage, over in zip(payload.HASH_STAGES, (stored, body, b"onetwo"), strict=True):
        assert payload.decoded(stored, True, "gzip", stage) == (b"onetwo", digest(over), None)
    assert payload.gunzip(body + b"\0\0")[0] == b"onetwo" and payload.gunzip(body[:-12])[1] and payload.gunzip(b"no")[0] == b"no"


def test_the_header_decides_the_digest_of_what_is_no_response(spark):
    own, other = "sha1:" + "A" * 32, "sha1:" + "B" * 32
    rows = [("response", own, other), ("resource", own, other), ("revisit", own, other), ("resource", own, "md5:x"), ("resource", own, None), ("revisit", None, other)]
    df = spark.createDataFrame(rows, "t string, c string, d string")
    got = [r.h for r in df.select(payload.chosen_digest(F.col("t"), F.col("c"), F.col("d")).alias("h")).collect()]
    assert got == [own, other, other, own, own, other]


def test_documents(spark, folder):
    docs = documents(captures.read(spark, f"{folder}/a.warc"), DATASET)
    rows = {r.url: r for r in docs.where("record_type != 'request'").collect()}
    assert "ftp://example.org/f" not in rows
    page = rows["http://www.example.org/"]
    assert page.id.startswith("201908150102/")
    assert page.title == "A page" and page.host == "www.example.org" and page.domain == "example.org"
    assert page.links == ["http://www.example.org/x%20y", "http://www.other.co.uk/"]
    assert page.links_domains == ["example.org", "other.co.uk"] and page.content_type_norm == "html"
    assert rows["http://example.org/plain.pdf"].content_type == "application/pdf"
    default = {r.url for r in documents(captures.read(spark, f"{folder}/a.warc"), DEFAULT).select("url").collect()}
    assert "http://www.example.org/missing" not in default and "http://example.org/plain.pdf" in default


def test_filters(spark):
    rows = spark.createDataFrame([("response", "http://a/", "200"), ("response", "http://b/", None), ("resource", "http://c/", None), ("metadata", "http://d/", "200"), ("response", None, "200"), ("response", "dns:e", "200")], "record_type string, url string, http_status string")
    assert {r.url for r in records.select(rows, DEFAULT).collect()} == {"http://a/", "http://c/"}
    n = spark.range(10000).where(records.sampled(F.col("id"), 10)).count()
    assert 800 < n < 1200


def test_html_features():
    f = html.parse(PAGE.decode(), "http://www.example.org/")
    assert f["title"] == "A page" and f["first_paragraph"] == "First words" and f["lang"] == "en" and f["canonical"] == "/c"
    assert f["images"] == ["http://www.example.org/i.png"] and "script" in f["elements"] and "var p" not in f["text"]
    assert html.parse("", None)["links"] == [] and html.parse("<a href='http://[bad'>", "http://x/")["links"] == []


def test_images():
    rng = np.random.default_rng(1)
    grey = np.kron(rng.random((16, 16)), np.ones((32, 32))) * 255
    one = images.pdq(grey)
    assert images.hamming(one["original"], images.pdq(grey + rng.random(grey.shape))["original"]) <= 16
    for name, turned in (("rotate180", grey[::-1, ::-1]), ("flipx", grey[::-1]), ("flipy", grey[:, ::-1]), ("flipplus", grey.T)):
        own = images.pdq(turned)["original"]
        assert min(one, key=lambda v: images.hamming(one[v], own)) == name
    assert len(images.phash(grey)) == 16
    assert images.dimensions(b"\x89PNG\r\n\x1a\n" + b"\0\0\0\rIHDR" + (7).to_bytes(4, "big") + (5).to_bytes(4, "big")) == (5, 7)
    assert images.dimensions(b"GIF89a" + (3).to_bytes(2, "little") + (4).to_bytes(2, "little")) == (4, 3) and images.dimensions(b"?") is None


def test_annotation_files(spark, tmp_path):
    file = tmp_path / "rules.json"
    file.write_text(json.dumps({"collections": {"root": {"http://a.org": {"collection": "A", "collections": ["A", "A|B"], "subject": ["s"]}}}, "collectionDateRanges": {"A": {"start": "2019-01-01T00:00:00.000Z", "end": None}}}))
    own, spans = rules.annotations(spark, str(file))
    assert own.collect()[0].key == "http://a.org" and spans.collect()[0].end is None
    rules.write_annotations(own, spans, str(tmp_path / "again"))
    own2, spans2 = rules.annotations(spark, str(tmp_path / "again"))
    assert own2.collect() == own.collect() and spans2.collect() == spans.collect()
    (tmp_path / "list.txt").write_text("# comment\n\nhttp://(org,\n")
    assert [r.prefix for r in rules.prefixes(spark, str(tmp_path / "list.txt")).collect()] == ["http://(org,"]


def test_annotation_bounds_are_exclusive(spark):
    caps = spark.sql("SELECT 'x' AS id, 'http://a.org' AS url, 'f' AS source_file, timestamp'2020-01-01' AS crawl_date")
    own = spark.createDataFrame([("root", "http://a.org", "A", ["A"], ["s"])], "scope string, key string, collection string, collections array<string>, subject array<string>")
    at = spark.sql("SELECT 'A' AS collection, timestamp'2020-01-01' AS start, CAST(NULL AS timestamp) AS end")
    row = annotate.annotate(caps, own, at).collect()[0]
    assert row.collections is None and row.wct_subjects == ["s"]
    assert annotate.annotate(caps, own, at.withColumn("start", F.lit(None).cast("timestamp"))).collect()[0].collections == ["A"]


def test_names(spark):
    own = [(r"a-(\d+)", {"n": "$1"}), (r"a-.*", {"n": "x", "m": "y"})]
    rows = spark.createDataFrame([("a-12", 1), ("a-z", 2), ("b", 3)], "name string, line int")
    f = names.fields(F.col("name"), own)
    assert [tuple(r) for r in rows.select(f["n"], f["m"]).collect()] == [("12", None), ("x", "y"), (None, None)]
    assert {r.rule: r.matches for r in names.statistics(rows, own).collect()} == {0: 1, 1: 1, -1: 1}


def test_sinks(spark, tmp_path):
    docs = spark.createDataFrame([("1", ["a", None, "b"], None, "f")], "id string, v array<string>, w string, source_file string")
    sinks.write_jsonl(docs, str(tmp_path / "j"), gzip=False)
    assert json.loads(open(glob.glob(str(tmp_path / "j/source_file=f/*.json"))[0]).read()) == {"id": "1", "v": ["a", None, "b"], "w": None}
    sinks.write_xml(docs, str(tmp_path / "x"))
    whole = "".join(open(f).read() for f in glob.glob(str(tmp_path / "x/part-*")))
    assert '<field name="v">b</field>' in whole and 'name="w"' not in whole and "<add>" in whole
    sinks.write_xml(docs, str(tmp_path / "y"), each=True, by="source_file")
    assert '<field name="source_file">f</field>' in open(glob.glob(str(tmp_path / "y/of_source_file=f/part-*"))[0]).read()
    with pytest.raises(ValueError):
        sinks.write(docs)
    with pytest.raises(ValueError):
        sinks.endpoint("ftp://x/y")
    assert sinks.endpoint("http://h:9200/i") == sinks.Endpoint("http", "h", 9200, "i")
    body = json.loads(sinks.bulk_document(docs).collect()[0].body)
    assert body["v"] == ["a", None, "b"] and body["source_file"] == ["f"] and "w" not in body


def test_bulk_retries():
    sent, fails = [], [OSError("once")]

    def post(lines: str) -> None:
        if fails:
            raise fails.pop()
        sent.append(lines)

    sinks.bulk_sender(post, "i")([{"_id": "1", "body": "{}"}])
    assert sent == ['{"index": {"_index": "i", "_id": "1"}}\n{}\n']


def test_servers(spark):
    import http.server
    import threading

    got, refuse = [], [True]

    class Handler(http.server.BaseHTTPRequestHandler):
        def do_POST(self):
            body = self.rfile.read(int(self.headers["Content-Length"])).decode()
            got.append((self.path, self.headers["Content-Type"], body))
            self.send_response(500 if self.path.startswith("/c") and refuse.pop() else 200) if refuse else self.send_response(200)
            self.end_headers()
            self.wfile.write(b'{"errors": false}')

        def log_message(self, *_):
            pass

    server = http.server.ThreadingHTTPServer(("127.0.0.1", 0), Handler)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    base = f"http://127.0.0.1:{server.server_port}"
    sinks.update_sender([f"{base}/c"])([{"id": "1", "v": ["a"], "w": None}])
    assert [g[0] for g in got] == ["/c/update?commitWithin=60000"] * 2 and json.loads(got[1][2]) == [{"id": "1", "v": ["a"]}]
    sinks.index_sender([f"{base}/i"])([{"_id": "1", "body": "{}"}])
    assert got[-1] == ("/_bulk", "application/x-ndjson", '{"index": {"_index": "i", "_id": "1"}}\n{}\n')
    server.shutdown()


def test_analysers_have_gates(spark):
    pages = spark.createDataFrame([(1, "http://a.org/", "<html><p>x</p></html>")], "page_id long, url string, html string")
    own = plans.register(plans.Analyser(lambda c: {"shout": F.upper("title"), "n": F.lit(c.n_first_bytes)}, ("html",), lambda c: c.first_bytes))
    other = plans.register(plans.Analyser(lambda c: {"never": F.lit(1)}, ("pdf",)))
    try:
        row = documents(captures.from_pages(pages), DATASET).first()
        assert row.n == 32 and row.never is None and "shout" not in documents(captures.from_pages(pages)).columns
    finally:
        plans._ANALYSERS.remove(own)
        plans._ANALYSERS.remove(other)


def test_search(spark):
    docs = spark.createDataFrame([(1, "The Cat sat", "en"), (2, "the dog", "en"), (3, None, "de")], "id int, text string, lang string")
    ids = lambda q: [r.id for r in search.search(docs, q).orderBy("id").collect()]
    assert ids("text:cat") == [1] and ids("*:*") == [1, 2, 3] and ids('text:the AND lang:"en"') == [1, 2] and ids("lang:d*") == [3]
    assert [r.id for r in search.elevate(docs, [3], [1]).orderBy("place").collect()] == [3, 2]


def test_counts(spark):
    rows = spark.createDataFrame([("a", "x", 1.0), ("a", "y", 3.0), ("a", "y", 1.0)], "p string, c string, v double")
    assert [(r.child, r.total, r.place) for r in summaries.timers(rows, "p", "c", "v", 1).collect()] == [("y", 4.0, 1)]
    assert summaries.facet(spark.createDataFrame([(["a", "b"],), ([],)], "t array<string>"), "t").count() == 2


def test_enrichment(spark):
    docs = spark.createDataFrame([("1", "5"), ("2", None)], "id string, n string")
    got = enrich(docs, {"n": "number"}, {"answer": "found"}, lambda q: {"answer": q["number"] + 1} if q["number"] else None)
    assert {r.id: r.found for r in got.collect()} == {"1": "6", "2": None}
    batch = enrich(docs.withColumn("found", F.lit("old")), {"n": "number"}, {"answer": "found"}, many=lambda qs: [{"answer": q["number"] + 1} if q["number"] else None for q in qs], at_once=1)
    assert {r.id: r.found for r in batch.collect()} == {"1": "6", "2": "old"}
    with pytest.raises(ValueError):
        enrich(docs, {}, {})


def test_rules_are_read_again():
    now, reads = [0.0], []
    own = rules.Reloaded(lambda: reads.append(1) or len(reads), 60, lambda: now[0])
    assert [own.get(), own.get()] == [1, 1]
    now[0] = 60
    assert own.get() == 2


def test_streams(spark, folder, tmp_path):
    records_ = streams.read_archives(spark, folder, "*.warc*")
    query = streams.write_stream(streams.stream_documents(records_, DEFAULT), str(tmp_path / "out"), str(tmp_path / "state"))
    query.awaitTermination(120)
    got = spark.read.parquet(str(tmp_path / "out"))
    assert got.count() == got.select("id").distinct().count() and got.where("url = 'http://www.example.org/'").count() == 1


def test_xml_gives_back_empty_blank_and_odd_values(spark, tmp_path):
    given = [(i, v) for i, v in enumerate(["", " ", "\t\n", " a ", "a\r\nb", "\x00", "\x0bx", "\ufffe", "\U0001f600", "<&>]]>", "null", None])]
    sinks.write_xml(spark.createDataFrame(given, "i int, v string"), str(tmp_path / "x"))
    rows = [{f.name: f.value for f in r.fields} for r in sinks.read_xml(spark, str(tmp_path / "x")).collect()]
    assert sorted((int(r["i"]), r.get("v")) for r in rows) == given


def test_xml_roundtrip_keeps_empty_texts_and_odd_sources(spark, tmp_path):
    given = [(1, "", " a"), (2, "x", "\x0b"), (3, "y", ""), (4, "z", None), (5, " ", " ")]
    spark.createDataFrame(given, "doc_id long, text string, source string").write.parquet(str(tmp_path / "documents.parquet"))
    got = catalogue.QUERIES["xml_roundtrip"](spark, str(tmp_path)).collect()
    assert sorted((r.doc_id, r.md5, r.source) for r in got) == [(i, hashlib.md5(t.encode()).hexdigest(), s) for i, t, s in given]


def _parses(frame) -> int:
    return frame._jdf.queryExecution().executedPlan().toString().count("ArrowEvalPython [")


def test_pages_are_parsed_once_and_in_runs(spark, sf, monkeypatch):
    assert _parses(catalogue.QUERIES["parsed_links"](spark, sf)) == 1
    assert list(batches.runs(pa.array(["a", None, "b" * 999, "", "c"]), 130)) == [(0, 2), (2, 3), (3, 5)] and list(batches.runs(pa.array([], pa.string()))) == []
    monkeypatch.setattr(batches, "TOGETHER", 300)
    pages = [PAGE.decode(), None, "", "<a href=x>é</a>" * 50, PAGE.decode()]
    got = html._parsed(pa.array(pages), pa.array(["http://a.org/"] * 4 + [None]), False, tuple(html.FEATURES.names)).to_pylist()
    for row, page, base in zip(got, pages, ["http://a.org/"] * 4 + [None], strict=True):
        want = dict.fromkeys(html.FEATURES.names) if page is None else html.parse(page, base)
        assert {**row, "meta": None if row["meta"] is None else dict(row["meta"])} == want


def test_page_text_leaves_python_alone(spark, sf):
    assert "licenses" not in catalogue.QUERIES["page_text"](spark, sf)._jdf.queryExecution().executedPlan().toString()


def test_linked_hosts_parse_pages_once(spark, sf):
    plan = catalogue.QUERIES["linked_hosts"](spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert sum("parsed(" in line for line in plan.splitlines() if line.lstrip(" :+-*()0123456789").startswith("ArrowEvalPython")) == 1
