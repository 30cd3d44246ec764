"""Queries over the driver's tables, one for each family of operators, and DuckDB SQL for the same results."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandline.config import FieldRule
from strandline.functions import dates, fields, html, images, payload, text, types, urls
from strandline.operators import annotate, names, records, search, summaries
from strandline.operators.suffixes import suffixes
from strandline.plans.documents import documents
from strandline.plans.enrich import enrich
from strandline.sources import captures, rules, sinks
from strandline.streaming.captures import counts_by_window, stream_documents, write_stream

QUERIES: dict = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


def _t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_HOST = "lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)', 1))"
_PATH = "regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)', 1)"
_NAME = "regexp_replace(regexp_extract(url, '([^/]*)$', 1), '[?&].*$', '')"
_EXT = f"CASE WHEN contains({_NAME}, '.') THEN regexp_replace(lower(regexp_extract({_NAME}, '([^.]*)$', 1)), '[^0-9a-z]', '', 'g') END"


@query(f"SELECT page_id, lower(regexp_extract(url, '^([A-Za-z][A-Za-z0-9+.-]*)://', 1)) AS scheme, {_HOST} AS host, {_PATH} AS path, {_NAME} AS resource, {_EXT} AS ext FROM pages")
def url_parts(spark, sf):
    u = F.col("url")
    name = urls.resource_name(u)
    return _t(spark, sf, "pages").select("page_id", urls.scheme(u).alias("scheme"), urls.host(u).alias("host"), urls.path(u).alias("path"), name.alias("resource"), urls.extension(name).alias("ext"))


@query(
    rf"""WITH u AS (SELECT page_id, url FROM pages UNION ALL SELECT page_id, regexp_extract(url, '^[a-z]+://[^/?#]*') || CASE page_id % 3 WHEN 0 THEN '/index.html' WHEN 1 THEN '/robots.txt' ELSE '' END FROM pages)
    SELECT CASE WHEN regexp_matches(lower({_PATH}), '^/?$|^/index\.[a-z]+$') THEN 'slashpage' WHEN lower({_PATH}) = '/robots.txt' THEN 'robots.txt' ELSE 'normal' END AS url_type, count(*) AS n FROM u GROUP BY 1"""
)
def url_types(spark, sf):
    pages = _t(spark, sf, "pages").select("page_id", "url")
    end = F.when(F.col("page_id") % 3 == 0, "/index.html").when(F.col("page_id") % 3 == 1, "/robots.txt").otherwise("")
    more = pages.select("page_id", F.concat(F.regexp_extract("url", "^[a-z]+://[^/?#]*", 0), end).alias("url"))
    return pages.union(more).groupBy(urls.url_type(F.col("url")).alias("url_type")).agg(F.count("*").alias("n"))


@query("SELECT page_id, '20240101000000/' || to_base64(unhex(md5(url))) AS id FROM pages")
def record_ids(spark, sf):
    return _t(spark, sf, "pages").select("page_id", urls.record_id(F.col("url"), F.lit("20240101000000")).alias("id"))


_CANON = r"""regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(lower(url), '[?&]+$', ''), '^https://', 'http://'), '^([a-z]+://)(?:www[0-9]*|ww2|ww)\.(.+)$', '\1\2'), '/+$', ''), '^(http://[^/]+)$', '\1/'), '^(http://[^/?#:]*):[0-9]+', '\1')"""


@query(f"SELECT page_id, {_CANON} AS canonical FROM pages")
def canonical_native(spark, sf):
    return _t(spark, sf, "pages").select("page_id", urls.canonical_ascii(F.col("url")).alias("canonical"))


@query(rf"WITH u AS (SELECT page_id, url FROM pages) SELECT page_id, {_CANON} AS canonical, {_CANON.replace('url', 'url2')} AS with_port FROM (SELECT page_id, url, regexp_replace(url, '^([a-z]+://[^/?#]*)', '\1:8080') AS url2 FROM u)")
def canonical_full(spark, sf):
    port = F.regexp_replace("url", "^([a-z]+://[^/?#]*)", "$1:8080")
    return _t(spark, sf, "pages").select("page_id", urls.canonical_url("url").alias("canonical"), urls.canonical_url(port).alias("with_port"))


_LEVELS = "list_transform(range(1, len(string_split(h, '.')) + 1), lambda i: array_to_string(list_slice(string_split(h, '.'), len(string_split(h, '.')) - i + 1, len(string_split(h, '.'))), '.'))"


@query(
    f"""SELECT page_id, regexp_replace(h, '^(www[0-9]*|ww2|ww)\\.', '') AS canonical_host, array_to_string({_LEVELS}, '|') AS levels,
    array_to_string(list_transform({_LEVELS}, lambda x: '(' || array_to_string(list_reverse(string_split(x, '.')), ',') || ','), '|') AS surts FROM (SELECT page_id, {_HOST} AS h FROM pages)"""
)
def host_keys(spark, sf):
    h = urls.host(F.col("url"))
    return _t(spark, sf, "pages").select("page_id", urls.canonical_host(h).alias("canonical_host"), F.array_join(urls.host_levels(h), "|").alias("levels"), F.array_join(urls.host_surts(h), "|").alias("surts"))


_UK = "(SELECT page_id, CASE WHEN page_id % 2 = 0 THEN regexp_replace(h, '\\.[a-z]+$', '.co.uk') ELSE h END AS h FROM (SELECT page_id, " + _HOST + " AS h FROM pages))"
_LAST = lambda n: f"array_to_string(list_slice(string_split(h, '.'), len(string_split(h, '.')) - {n - 1}, len(string_split(h, '.'))), '.')"


@query(f"SELECT page_id, CASE WHEN h LIKE '%.uk' THEN {_LAST(3)} ELSE {_LAST(2)} END AS domain, CASE WHEN h LIKE '%.uk' THEN {_LAST(2)} ELSE {_LAST(1)} END AS suffix FROM {_UK}")
def host_domains(spark, sf):
    h = urls.host(F.col("url"))
    h = F.when(F.col("page_id") % 2 == 0, F.regexp_replace(h, r"\.[a-z]+$", ".co.uk")).otherwise(h)
    rows = _t(spark, sf, "pages").select("page_id", h.alias("h"))
    return rows.select("page_id", urls.domain(F.col("h")).alias("domain"), urls.public_suffix(F.col("h")).alias("suffix"))


@query("SELECT page_id, url FROM pages WHERE starts_with(url, 'https')")
def protocol_filter(spark, sf):
    return _t(spark, sf, "pages").where(records.with_protocol(F.col("url"), ("https",))).select("page_id", "url")


@query(r"SELECT page_id, url FROM pages WHERE NOT regexp_matches(url, 'utm_source|\.html') AND NOT regexp_matches(url, '/de/')")
def url_exclude_filter(spark, sf):
    return _t(spark, sf, "pages").where(~records.excluded_url(F.col("url"), (r"utm_source|\.html", "/de/"))).select("page_id", "url")


@query("SELECT status, count(*) AS n FROM (SELECT CASE page_id % 4 WHEN 0 THEN '200' WHEN 1 THEN '404' WHEN 2 THEN '301' END AS status FROM pages) WHERE starts_with(status, '2') OR starts_with(status, '30') GROUP BY 1")
def status_filter(spark, sf):
    m = F.col("page_id") % 4
    rows = _t(spark, sf, "pages").withColumn("status", F.when(m == 0, "200").when(m == 1, "404").when(m == 2, "301"))
    return rows.where(records.with_status(F.col("url"), F.col("status"), ("2", "30"))).groupBy("status").agg(F.count("*").alias("n"))


_BARE = r"regexp_replace(lower(url), '^(https?://)?(www[0-9]*\.)?', '')"


@query(f"SELECT page_id, url FROM pages WHERE NOT EXISTS (SELECT 1 FROM (VALUES ('tionsh.'), ('blog.'), ('ththan.example.net/en')) v(p) WHERE starts_with({_BARE}, p))")
def exclusion_list(spark, sf):
    listed = spark.createDataFrame([("http://www.tionsh.",), ("blog.",), ("ththan.example.net/en",)], "prefix string")
    return annotate.not_excluded(_t(spark, sf, "pages").select("page_id", "url"), listed, "page_id")


_LINKS = f"(SELECT page_id, {_HOST} AS host, regexp_extract(url, '^([a-z]+://[^/?#]*)', 1) || unnest(regexp_extract_all(html, '<a [^>]*?href=\"([^\"]*)\"', 1)) AS link FROM pages)"


def _links(spark, sf) -> DataFrame:
    site = F.regexp_extract("url", "^([a-z]+://[^/?#]*)", 1)
    return _t(spark, sf, "pages").select("page_id", urls.host(F.col("url")).alias("host"), site.alias("site"), F.explode(html.native_hrefs(F.col("html"))).alias("l")).select("page_id", "host", F.concat("site", "l").alias("link"))


@query(f"SELECT page_id, link FROM {_LINKS}")
def page_links(spark, sf):
    return _links(spark, sf).select("page_id", "link")


@query(f"SELECT page_id, count(DISTINCT link) AS n FROM {_LINKS} GROUP BY page_id")
def parsed_links(spark, sf):
    pages = _t(spark, sf, "pages").select("page_id", html.feature("links", "html", "url").alias("links"))
    return pages.select("page_id", F.size("links").cast("long").alias("n")).where("n > 0")


@query(f"SELECT host, count(*) AS n, count(DISTINCT link) AS n_distinct FROM {_LINKS} GROUP BY host")
def links_per_host(spark, sf):
    return _links(spark, sf).groupBy("host").agg(F.count("*").alias("n"), F.count_distinct("link").alias("n_distinct"))


@query(f"SELECT host AS src, regexp_extract(link, '^[a-z]+://([^/?#]*)', 1) AS dst, count(*) AS n FROM {_LINKS} GROUP BY 1, 2")
def host_edges(spark, sf):
    per_page = _links(spark, sf).select("host", F.array(urls.host(F.col("link"))).alias("hosts"))
    return summaries.host_edges(per_page, "host", "hosts").groupBy("src", "dst").agg(F.count("*").alias("n"))


@query("SELECT tag, count(DISTINCT page_id) AS n FROM (SELECT page_id, lower(unnest(regexp_extract_all(html, '<([a-zA-Z][a-zA-Z0-9]*)', 1))) AS tag FROM pages) GROUP BY tag")
def elements_used(spark, sf):
    pages = _t(spark, sf, "pages").select("page_id", F.explode(html.native_tags(F.col("html"))).alias("tag"))
    return pages.groupBy("tag").agg(F.count_distinct("page_id").alias("n"))


@query("SELECT tag, count(*) AS n FROM (SELECT DISTINCT page_id, lower(unnest(regexp_extract_all(html, '<([a-zA-Z][a-zA-Z0-9]*)', 1))) AS tag FROM pages) GROUP BY tag")
def parsed_elements(spark, sf):
    pages = _t(spark, sf, "pages").select(html.feature("elements", "html", "url").alias("tags"))
    return pages.select(F.explode("tags").alias("tag")).where(~F.contains("tag", F.lit("/"))).groupBy("tag").agg(F.count("*").alias("n"))


@query("SELECT page_id, trim(regexp_extract(html, '<title[^>]*>([^<]*)</title>', 1)) AS title, regexp_extract(html, '<html lang=\"([^\"]*)\"', 1) AS lang FROM pages")
def page_titles(spark, sf):
    return _t(spark, sf, "pages").select("page_id", html.native_title(F.col("html")).alias("title"), F.regexp_extract("html", '<html lang="([^"]*)"', 1).alias("lang"))


@query()
def page_text(spark, sf):
    pages = _t(spark, sf, "pages").select("page_id", html.feature("text", "html", "url").alias("text"))
    return pages.select("page_id", F.length("text").alias("n"), F.md5(F.col("text").cast("binary")).alias("md5"))


_TYPES = ["image/png", "audio/ogg", "application/vnd.rn-realaudio", "video/webm", "application/mp4", "text/html; charset=utf-8", "application/xhtml+xml", "application/pdf", "application/msword", "application/vnd.ms-excel", "application/vnd.ms-powerpoint", "text/plain", "application/json", "text/css"]
_VALUES = ", ".join(f"('{t}')" for t in _TYPES)
_CASES = " ".join(f"WHEN regexp_matches(t, '{pattern}') THEN '%s'" for _, _, pattern in types.KINDS)


@query(f"SELECT t, CASE {_CASES % tuple(k for k, _, _ in types.KINDS)} ELSE 'other' END AS kind, CASE {_CASES % tuple(k for _, k, _ in types.KINDS)} ELSE 'Other' END AS label, regexp_replace(t, ';.*$', '') AS bare FROM (VALUES {_VALUES}) v(t)")
def content_kinds(spark, sf):
    t = F.col("t")
    return spark.createDataFrame([(x,) for x in _TYPES], "t string").select("t", types.kind(t).alias("kind"), types.label(t).alias("label"), types.bare(t).alias("bare"))


@query(r"SELECT doc_id, nullif(substr(regexp_replace(trim(regexp_replace(chr(9) || text || chr(7) || chr(10) || '  x', '[\x00-\x1F\x7F]', ' ', 'g')), '[ \t\n\r\f\v]+', ' ', 'g'), 1, 100), '') AS value FROM documents")
def adjusted_field(spark, sf):
    value = F.concat(F.lit("\t"), F.col("text"), F.lit("\x07\n  x"))
    return _t(spark, sf, "documents").select("doc_id", fields.adjust(value, FieldRule(max_length=100)).alias("value"))


@query("SELECT page_id, regexp_replace(regexp_replace(url || '%20' || (page_id % 5) || 'w', '%20[0-9.]+[wx]$', ''), '^https', 'http') AS url_norm FROM pages")
def rewritten_field(spark, sf):
    value = F.concat(F.col("url"), F.lit("%20"), (F.col("page_id") % 5).cast("string"), F.lit("w"))
    return _t(spark, sf, "pages").select("page_id", fields.adjust(value, FieldRule(rewrites=(("%20[0-9.]+[wx]$", ""), ("^https", "http")))).alias("url_norm"))


@query("SELECT doc_id, array_to_string(list_slice(list_transform(list_sort(list_distinct(list_transform(w, lambda x, i: {'w': x, 'at': list_position(w, x)})), 'ASC'), lambda s: s.w), 1, 5), '|') AS value FROM (SELECT doc_id, list_filter(string_split(regexp_replace(text, '[ \\t\\n\\r\\f\\v]+', ' ', 'g'), ' '), lambda x: x != '') AS w FROM documents)".replace("{'w': x, 'at': list_position(w, x)}", "{'at': list_position(w, x), 'w': x}"))
def capped_values(spark, sf):
    words = F.filter(F.split(F.regexp_replace("text", r"[ \t\n\r\f\x0B]+", " "), " "), lambda w: w != "")
    return _t(spark, sf, "documents").select("doc_id", F.array_join(fields.adjust_values(words, FieldRule(max_values=5)), "|").alias("value"))


@query("SELECT doc_id, md5(trim(lower(regexp_replace(text, '[ \\t\\n\\r\\f\\v]+', ' ', 'g')))) AS md5 FROM documents")
def fuzzy_text(spark, sf):
    return _t(spark, sf, "documents").select("doc_id", F.md5(text.fuzzy_text(F.col("text")).cast("binary")).alias("md5"))


@query()
def fuzzy_hashes(spark, sf):
    h = text.fuzzy(text.fuzzy_text(F.col("text")))
    rows = _t(spark, sf, "documents").select("doc_id", h.alias("h"))
    return rows.select("doc_id", F.col("h.bs").alias("bs"), text.fuzzy_line(F.col("h"), F.col("doc_id").cast("string")).alias("line"))


_GRAMS = r"(SELECT doc_id, lang, substr(t, i, 3) AS ngram FROM (SELECT doc_id, lang, t, unnest(range(1, length(t) - 1)) AS i FROM (SELECT doc_id, lang, regexp_replace(lower(text), '[^\p{L}]', '_', 'g') AS t FROM documents WHERE text IS NOT NULL)))"


@query(f"SELECT lang, ngram, count(*) AS n FROM {_GRAMS} GROUP BY ALL")
def trigram_profiles(spark, sf):
    return summaries.trigram_counts(_t(spark, sf, "documents"), "text", "lang")


@query(f"SELECT lang, ngram, n, place FROM (SELECT lang, ngram, n, row_number() OVER (PARTITION BY lang ORDER BY n DESC, ngram) AS place FROM (SELECT lang, ngram, count(*) AS n FROM {_GRAMS} GROUP BY ALL)) WHERE place <= 10")
def top_trigrams(spark, sf):
    counts = summaries.trigram_counts(_t(spark, sf, "documents"), "text", "lang").select(F.col("lang").alias("parent"), F.col("ngram").alias("child"), F.col("n").alias("value"))
    return summaries.timers(counts, "parent", "child", "value", 10).select(F.col("parent").alias("lang"), F.col("child").alias("ngram"), F.col("total").alias("n"), "place")


@query(
    f"""WITH g AS MATERIALIZED (SELECT * FROM {_GRAMS}), o AS (SELECT doc_id, ngram, count(*) / any_value(a)::DOUBLE AS f FROM g JOIN (SELECT doc_id, count(*) AS a FROM g GROUP BY 1) USING (doc_id) GROUP BY 1, 2),
    t AS (SELECT lang, ngram, count(*) / any_value(a)::DOUBLE AS h FROM g JOIN (SELECT lang, count(*) AS a FROM g GROUP BY 1) USING (lang) GROUP BY 1, 2),
    d AS (SELECT doc_id, lang, sqrt(greatest(a + b - 2 * coalesce(c, 0), 0)) AS d FROM (SELECT doc_id, sum(f * f) AS a FROM o GROUP BY 1) CROSS JOIN (SELECT lang, sum(h * h) AS b FROM t GROUP BY 1) LEFT JOIN (SELECT doc_id, lang, sum(f * h) AS c FROM o JOIN t USING (ngram) GROUP BY 1, 2) USING (doc_id, lang))
    SELECT doc_id, CASE WHEN min(d) < 1 THEN arg_min(lang, d) ELSE 'unknown' END AS lang, round(min(d), 6) AS distance FROM d GROUP BY doc_id"""
)
def nearest_language(spark, sf):
    docs = _t(spark, sf, "documents")
    got = summaries.nearest_profile(docs, summaries.trigram_counts(docs, "text", "lang"), "doc_id", "text")
    return got.select("doc_id", "lang", F.round("distance", 6).alias("distance"))


@query(
    r"""SELECT doc_id, array_to_string(list_sort(list_distinct(p)), '|') AS postcodes, array_to_string(list_sort(list_distinct(list_transform(p, lambda x: string_split(x, ' ')[1]))), '|') AS districts
    FROM (SELECT doc_id, regexp_extract_all(text || ' SW1A 1AA, EC' || (doc_id % 4) || ' 2AB SW1A 1AA', '[A-Z]{1,2}[0-9R][0-9A-Z]? [0-9][ABD-HJLNP-UW-Z]{2}') AS p FROM documents)"""
)
def postcodes(spark, sf):
    found = text.postcodes(F.concat(F.col("text"), F.lit(" SW1A 1AA, EC"), (F.col("doc_id") % 4).cast("string"), F.lit(" 2AB SW1A 1AA")))
    rows = _t(spark, sf, "documents").select("doc_id", found.alias("p"))
    return rows.select("doc_id", F.array_join(F.array_sort("p"), "|").alias("postcodes"), F.array_join(F.array_sort(F.array_distinct(F.transform("p", text.district))), "|").alias("districts"))


@query("SELECT doc_id, d AS district, lat, lon FROM (SELECT doc_id, 'EC' || (doc_id % 4) AS d FROM documents) LEFT JOIN (VALUES ('EC1', 51.52::DOUBLE, -0.1::DOUBLE), ('EC2', 51.51::DOUBLE, -0.09::DOUBLE)) v(district, lat, lon) ON d = district")
def postcode_locations(spark, sf):
    places = spark.createDataFrame([("EC1", 51.52, -0.1), ("EC2", 51.51, -0.09)], "district string, lat double, lon double")
    rows = _t(spark, sf, "documents").select("doc_id", F.concat(F.lit("EC"), (F.col("doc_id") % 4).cast("string")).alias("district"))
    return rows.join(F.broadcast(places), "district", "left")


_LEX = {"the": 1, "of": -1, "und": 2, "les": -2, "que": 3}
_SENT = "(SELECT doc_id, sum(CASE w " + " ".join(f"WHEN '{w}' THEN {n}" for w, n in _LEX.items()) + r" ELSE 0 END) AS s FROM (SELECT doc_id, unnest(string_split_regex(lower(substr(text, 1, 10000)), '[^\p{L}]+')) AS w FROM documents) GROUP BY doc_id)"
_MOODS = "[" + ", ".join(f"'{m}'" for m in text.MOODS) + "]"


@query(f"SELECT doc_id, round(x, 9) AS score, {_MOODS}[greatest(0, least(6, floor(7 * (0.5 + x))))::INT + 1] AS mood FROM (SELECT doc_id, sign(s) * ln(1 + abs(s)) / 40 AS x FROM {_SENT})")
def sentiments(spark, sf):
    rows = _t(spark, sf, "documents").select("doc_id", text.sentiment(F.col("text"), _LEX).alias("x"))
    return rows.select("doc_id", F.round("x", 9).alias("score"), text.mood(F.col("x")).alias("mood"))


@query("SELECT doc_id, min(doc_id) OVER (PARTITION BY sha1(text)) AS first FROM documents WHERE text IS NOT NULL")
def exact_duplicates(spark, sf):
    docs = _t(spark, sf, "documents").where("text is not null").select("doc_id", F.sha1(F.col("text").cast("binary")).alias("digest"))
    return summaries.duplicates(docs, "digest", "doc_id")


_RULES = [
    ("resource", "https://ththon.example.com/de/39887", "A", ["A", "A|One"], ["s1"]),
    ("root", "http://tionsh.example.net", "B", ["B"], ["s2"]),
    ("subdomains", "deep.ththan.example.net", "C", ["C", "C|Sub"], ["s1", "s3"]),
    ("source_file_matches", "part-[0-4]", "D", ["D"], ["s4"]),
]
_SOURCE = "'part-' || (page_id % 9)"


@query(
    f"""SELECT page_id, 'subdomains' AS scope, 'C' AS collection FROM (SELECT page_id, regexp_replace({_HOST}, '^(www[0-9]*|ww2|ww)\\.', '') AS h FROM pages) WHERE h IN ('net', 'example.net', 'ththan.example.net', 'deep.ththan.example.net')
    UNION ALL SELECT page_id, 'source_file_matches', 'D' FROM pages WHERE page_id % 9 <= 4
    UNION ALL SELECT page_id, 'resource', 'A' FROM pages WHERE url = 'https://ththon.example.com/de/39887'
    UNION ALL SELECT page_id, 'root', 'B' FROM pages WHERE url = 'http://tionsh.example.net'"""
)
def annotation_matches(spark, sf):
    rules = spark.createDataFrame(_RULES, "scope string, key string, collection string, collections array<string>, subject array<string>")
    pages = _t(spark, sf, "pages").select(F.col("page_id").alias("id"), "url", F.concat(F.lit("part-"), (F.col("page_id") % 9).cast("string")).alias("source_file"))
    return annotate.matches(pages, rules).select(F.col("id").alias("page_id"), "scope", "collection")


@query(
    f"""WITH m AS (SELECT page_id, d, regexp_replace({_HOST}, '^(www[0-9]*|ww2|ww)\\.', '') IN ('net', 'example.net', 'ththan.example.net', 'deep.ththan.example.net') AS c FROM (SELECT page_id, url, TIMESTAMP '2024-01-01' + to_days((page_id % 40)::INT) AS d FROM pages))
    SELECT page_id, nullif(concat_ws('|', CASE WHEN c AND d > '2024-01-10' AND d < '2024-02-05' THEN 'C' END, CASE WHEN page_id % 9 <= 4 AND d > '2024-01-05' THEN 'D' END), '') AS collections,
    nullif(concat_ws('|', CASE WHEN c THEN 's1|s3' END, CASE WHEN page_id % 9 <= 4 THEN 's4' END), '') AS subjects FROM m"""
)
def annotated_ranges(spark, sf):
    rules = spark.createDataFrame(_RULES[2:], "scope string, key string, collection string, collections array<string>, subject array<string>")
    spans = spark.createDataFrame([("C", "2024-01-10", "2024-02-05"), ("D", "2024-01-05", None)], "collection string, start string, end string").select("collection", F.to_timestamp("start").alias("start"), F.to_timestamp("end").alias("end"))
    day = F.expr("timestamp'2024-01-01' + make_interval(0, 0, 0, cast(page_id % 40 as int))")
    pages = _t(spark, sf, "pages").select(F.col("page_id").alias("id"), "url", F.concat(F.lit("part-"), (F.col("page_id") % 9).cast("string")).alias("source_file"), day.alias("crawl_date"))
    got = annotate.annotate(pages, rules, spans)
    return got.select(F.col("id").alias("page_id"), F.array_join("collections", "|").alias("collections"), F.array_join("wct_subjects", "|").alias("subjects"))


@query(f"SELECT page_id, CASE WHEN starts_with(url, 'https') AND (ends_with({_HOST}, '.org')) OR starts_with(url, 'http://') AND {_HOST} = 'tionsh.example.net' AND starts_with({_PATH}, '/fr') THEN 'OA' ELSE 'RRO' END AS access_terms FROM pages")
def access_terms(spark, sf):
    listed = spark.createDataFrame([("https://(org,",), ("http://(net,example,tionsh,)/fr",)], "prefix string")
    return annotate.access_terms(_t(spark, sf, "pages").select("page_id", "url"), listed, "page_id").select("page_id", "access_terms")


_NAME_RULES = [(r"(job\d+)-(\d{4})(\d{2})(\d{2}).*", {"job": "$1", "day": "$2-$3-$4"}), (r".*/(src1\d)-(.*)", {"job": "$1", "full": "$2"}), (r"(src[0-4])-.*", {"job": "$1"})]
_ARCHIVE = "CASE doc_id % 3 WHEN 0 THEN 'job' || doc_id || '-20240105-x' WHEN 1 THEN 'a/' || source || '-' || doc_id ELSE source || '-' || doc_id END"
_MATCHED = f"(SELECT doc_id, n, CASE WHEN regexp_full_match(n, '(job\\d+)-(\\d{{4}})(\\d{{2}})(\\d{{2}}).*') THEN 0 WHEN regexp_full_match(n, '.*/(src1\\d)-(.*)') THEN 1 WHEN regexp_full_match(n, '(src[0-4])-.*') THEN 2 ELSE -1 END AS rule FROM (SELECT doc_id, {_ARCHIVE} AS n FROM documents))"


def _archive_names(spark, sf) -> DataFrame:
    k, i, s = F.col("doc_id") % 3, F.col("doc_id").cast("string"), F.col("source")
    name = F.when(k == 0, F.concat(F.lit("job"), i, F.lit("-20240105-x"))).when(k == 1, F.concat(F.lit("a/"), s, F.lit("-"), i)).otherwise(F.concat(s, F.lit("-"), i))
    return _t(spark, sf, "documents").select("doc_id", name.alias("name"))


@query(f"SELECT doc_id, CASE rule WHEN 0 THEN regexp_extract(n, '(job\\d+)-', 1) WHEN 1 THEN regexp_extract(n, '/(src1\\d)-', 1) WHEN 2 THEN regexp_extract(n, '(src[0-4])-', 1) END AS job, CASE WHEN rule = 0 THEN '2024-01-05' END AS day, CASE WHEN rule = 1 THEN doc_id::VARCHAR END AS full_name FROM {_MATCHED}")
def archive_name_fields(spark, sf):
    f = names.fields(F.col("name"), _NAME_RULES)
    return _archive_names(spark, sf).select("doc_id", f["job"].alias("job"), f["day"].alias("day"), f["full"].alias("full_name"))


@query(f"SELECT rule, count(*) AS matches, arg_max(n, doc_id) AS last_name FROM {_MATCHED} GROUP BY rule")
def archive_name_statistics(spark, sf):
    return names.statistics(_archive_names(spark, sf), _NAME_RULES, "name", "doc_id")


@query("SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS crawl_date, year(ts)::INT AS crawl_year, strftime(ts, '%Y%m%d%H%M%S')::BIGINT AS wayback_date, strftime(date_trunc('minute', ts), '%Y-%m-%dT%H:%M:%SZ') AS minute FROM events")
def wayback_dates(spark, sf):
    full = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'")
    minute = dates.wayback_time(F.date_format("ts", "yyyy-MM-dd'T'HH:mm"))
    back = dates.wayback_time(full)
    return _t(spark, sf, "events").select("event_id", dates.crawl_date(back).alias("crawl_date"), F.year(back).alias("crawl_year"), dates.wayback_date(back).alias("wayback_date"), dates.crawl_date(minute).alias("minute"))


@query("SELECT event_id, date_trunc('second', ts)::TIMESTAMP AS a, date_trunc('day', ts)::TIMESTAMP AS b, date_trunc('day', ts)::TIMESTAMP AS c FROM events")
def extracted_dates(spark, sf):
    of = lambda pattern: dates.extract_date(F.concat(F.lit("on "), F.date_format("ts", pattern)))
    return _t(spark, sf, "events").select("event_id", of("dd/MM/yyyy HH:mm:ss").cast("timestamp_ntz").alias("a"), of("yyyy-MM-dd").cast("timestamp_ntz").alias("b"), of("d MMMM yyyy").cast("timestamp_ntz").alias("c"))


@query("SELECT year(ts)::INT AS crawl_year, event_type, count(*) AS n FROM events GROUP BY ALL")
def crawl_facets(spark, sf):
    return summaries.facet(_t(spark, sf, "events").withColumn("crawl_year", F.year("ts")), "crawl_year", "event_type")


@query("SELECT tag, lang, count(*) AS n FROM (SELECT lang, unnest([source, lang]) AS tag FROM documents) GROUP BY ALL")
def facet_values(spark, sf):
    return summaries.facet(_t(spark, sf, "documents").withColumn("tag", F.array("source", "lang")), "tag", "lang")


@query("SELECT parent, child, n, round(total, 4) AS total, place FROM (SELECT event_type AS parent, user_id AS child, count(*) AS n, sum(value) AS total, row_number() OVER (PARTITION BY event_type ORDER BY round(sum(value), 6) DESC, user_id) AS place FROM events GROUP BY 1, 2) WHERE place <= 5")
def timer_tree(spark, sf):
    events = _t(spark, sf, "events").groupBy("event_type", "user_id").agg(F.count("*").alias("n"), F.sum("value").alias("value"))
    got = summaries.timers(events.withColumn("value", F.round("value", 6)), "event_type", "user_id", "value", 5).join(events.select(F.col("event_type").alias("parent"), F.col("user_id").alias("child"), F.col("n").alias("m")), ["parent", "child"])
    return got.select("parent", "child", F.col("m").alias("n"), F.round("total", 4).alias("total"), "place")


@query("SELECT event_type AS type, round(sum(value), 4) AS total, count(*) AS n FROM events GROUP BY 1 ORDER BY sum(value) DESC LIMIT 3")
def slowest_types(spark, sf):
    events = _t(spark, sf, "events").withColumn("served", F.concat("event_type", F.lit("; charset=x")))
    return summaries.slowest_types(events, "served", "value", 3).select("type", F.round("total", 4).alias("total"), "n")


@query("SELECT ts_hour AS start, event_type, count(*) AS n FROM (SELECT date_trunc('hour', ts)::TIMESTAMP AS ts_hour, event_type FROM events) GROUP BY ALL")
def window_counts(spark, sf):
    got = counts_by_window(_t(spark, sf, "events"), "ts", "event_type")
    return got.select(F.col("start").cast("timestamp_ntz").alias("start"), "event_type", "n")


@query(r"SELECT doc_id FROM documents WHERE list_contains(string_split_regex(lower(text), '[^\p{L}\p{N}]+'), 'with') AND lang = 'en'")
def term_search(spark, sf):
    return search.search(_t(spark, sf, "documents"), 'text:With AND lang:"en"').select("doc_id")


@query("SELECT doc_id, source FROM documents WHERE starts_with(source, 'src1')")
def prefix_search(spark, sf):
    return search.search(_t(spark, sf, "documents"), "source:src1*").select("doc_id", "source")


@query("SELECT doc_id, CASE doc_id WHEN 7 THEN 0 WHEN 3 THEN 1 ELSE 2 END::INT AS place FROM documents WHERE doc_id NOT IN (5, 9)")
def elevated(spark, sf):
    return search.elevate(_t(spark, sf, "documents"), [7, 3], [5, 9], "doc_id").select("doc_id", "place")


@query("SELECT doc_id, coalesce(CASE WHEN quality = 1 THEN 'good' END, source) AS source, lang FROM documents LEFT JOIN labels USING (doc_id)")
def atomic_update(spark, sf):
    changes = _t(spark, sf, "labels").select("doc_id", F.when(F.col("quality") == 1, "good").alias("source"))
    return search.update(_t(spark, sf, "documents").select("doc_id", "source", "lang"), changes, "doc_id")


@query("SELECT page_id, trim(regexp_replace(lower(hex(encode(substr(html, 1, 32)))[1:64]), '(..)', '\\1 ', 'g')) AS first_bytes, lower(hex(encode(substr(html, 1, 4)))) AS ffb FROM pages")
def first_bytes(spark, sf):
    body = F.col("html").cast("binary")
    return _t(spark, sf, "pages").select("page_id", payload.first_bytes(body).alias("first_bytes"), payload.first_four(body).alias("ffb"))


@query(
    """SELECT page_id, count(*) AS n, min(s) AS low, max(s) AS high FROM (SELECT page_id, array_to_string(list_slice(w, i, i + k - 1), ' ') AS s FROM
    (SELECT page_id, w, unnest(range(1, 32 - k + 2)) AS i, k FROM (SELECT page_id, string_split(trim(regexp_replace(lower(hex(encode(substr(html, 1, 32)))[1:64]), '(..)', '\\1 ', 'g')), ' ') AS w FROM pages), (VALUES (4), (5), (6), (7), (8)) v(k))) GROUP BY page_id"""
)
def byte_shingles(spark, sf):
    tokens = F.split(payload.first_bytes(F.col("html").cast("binary")), " ")
    rows = _t(spark, sf, "pages").select("page_id", payload.shingles(tokens).alias("s"))
    return rows.select("page_id", F.size("s").cast("long").alias("n"), F.array_min("s").alias("low"), F.array_max("s").alias("high"))


@query(
    "SELECT page_id, 'sha1:' || " + " || ".join(f"translate(to_base(('0x' || substr(h, {1 + 10 * k}, 10))::BIGINT, 32, 8), '0123456789ABCDEFGHIJKLMNOPQRSTUV', '{payload.BASE32}')" for k in range(4)) + " AS digest FROM (SELECT page_id, sha1(html) AS h FROM pages)"
)
def payload_digests(spark, sf):
    return _t(spark, sf, "pages").select("page_id", payload.sha1_base32(F.col("html").cast("binary")).alias("digest"))


_COLOURS = [(0, "black", 0, 0, 0), (1, "red", 255, 0, 0), (2, "lime", 0, 255, 0), (3, "blue", 0, 0, 255), (4, "white", 255, 255, 255), (5, "gray", 128, 128, 128)]


@query(
    "SELECT p_partkey, arg_min(name, d * 10 + ord) AS colour FROM (SELECT p_partkey, ord, name, abs(p_partkey % 256 - r) + abs(p_size * 5 - g) + abs(p_partkey * 7 % 256 - b) AS d FROM part, (VALUES " + ", ".join(map(str, _COLOURS)) + ") v(ord, name, r, g, b)) GROUP BY 1"
)
def nearest_colours(spark, sf):
    palette = spark.createDataFrame(_COLOURS, "ord int, name string, r int, g int, b int")
    pixels = _t(spark, sf, "part").select("p_partkey", (F.col("p_partkey") % 256).alias("r"), (F.col("p_size") * 5).alias("g"), (F.col("p_partkey") * 7 % 256).alias("b"))
    return summaries.nearest_colour(pixels, palette).select("p_partkey", "colour")


@query("SELECT c_custkey, CASE WHEN c_custkey % 2 = 0 THEN -1 ELSE 1 END * round(c_custkey % 90 + (c_custkey % 60) / 60 + 30.5 / 3600, 9) AS degrees FROM customer")
def exif_degrees(spark, sf):
    k = F.col("c_custkey")
    value = F.concat(F.when(k % 2 == 0, "-").otherwise(""), (k % 90).cast("string"), F.lit("° "), (k % 60).cast("string"), F.lit("' 30,5\""))
    return _t(spark, sf, "customer").select("c_custkey", F.round(text.degrees(value), 9).alias("degrees"))


@query("SELECT n_nationkey, r_name || '|' || n_name AS path FROM nation JOIN region ON n_regionkey = r_regionkey WHERE r_name != 'ASIA'")
def taxonomy_paths(spark, sf):
    regions = _t(spark, sf, "region").select((F.col("r_regionkey") + 1000).alias("id"), F.lit(None).cast("int").alias("parent"), F.col("r_name").alias("name"), (F.col("r_name") != "ASIA").alias("published"))
    nations = _t(spark, sf, "nation").select(F.col("n_nationkey").alias("id"), (F.col("n_regionkey") + 1000).alias("parent"), F.col("n_name").alias("name"), F.lit(True).alias("published"))
    return annotate.taxonomy(regions.union(nations)).where("id < 1000").select(F.col("id").alias("n_nationkey"), "path")


@query("SELECT page_id, url, md5(html) AS md5 FROM pages")
def jsonl_roundtrip(spark, sf):
    folder = _scratch(spark, "jsonl")
    sinks.write_jsonl(_t(spark, sf, "pages").withColumn("source_file", F.lit("a")), folder)
    return spark.read.schema("page_id long, url string, html string").json(folder).select("page_id", "url", F.md5(F.col("html").cast("binary")).alias("md5"))


@query("SELECT doc_id, 300 + 32 + length('doc_id') + 128 + CASE WHEN source IS NULL THEN 0 ELSE 32 + 6 + 48 + 2 * length(source) END + CASE WHEN text IS NULL THEN 0 ELSE 32 + 4 + 48 + 2 * length(text) END AS bytes FROM documents")
def estimated_sizes(spark, sf):
    docs = _t(spark, sf, "documents").select("doc_id", "source", "text")
    return docs.select("doc_id", sinks.estimated_size(docs).cast("long").alias("bytes"))


@query("SELECT page_id, coalesce(served, '') || chr(9) || 'text/html' || chr(9) || '' AS triple FROM (SELECT page_id, CASE WHEN page_id % 2 = 0 THEN 'text/html' END AS served FROM pages)")
def format_triples(spark, sf):
    served = F.when(F.col("page_id") % 2 == 0, "text/html")
    return _t(spark, sf, "pages").select("page_id", sinks.format_triple(served, F.lit("text/html"), F.lit(None).cast("string")).alias("triple"))


@query(
    f"""SELECT p.page_id, '20240101000000/' || to_base64(unhex(md5(url))) AS id, {_HOST} AS host, {_PATH} AS url_path, 'html' AS content_type_norm, octet_length(encode(html)) AS content_length, coalesce(n, 0) AS n_links, 2024::INT AS crawl_year
    FROM pages p LEFT JOIN (SELECT page_id, count(DISTINCT link) AS n FROM {_LINKS} GROUP BY 1) USING (page_id)"""
)
def capture_documents(spark, sf):
    docs = documents(captures.from_pages(_t(spark, sf, "pages"), "2024-01-01T00:00:00Z"))
    return docs.select(F.col("offset").alias("page_id"), "id", "host", "url_path", "content_type_norm", "content_length", F.size("links").cast("long").alias("n_links"), "crawl_year")


@query(f"SELECT regexp_replace({_HOST}, '^(www[0-9]*|ww2|ww)\\.', '') AS host, count(*) AS n, max('20240101000000/' || to_base64(unhex(md5(url)))) AS last_id FROM pages GROUP BY 1 ORDER BY n DESC, host LIMIT 10")
def top_hosts(spark, sf):
    u = F.col("url")
    pages = _t(spark, sf, "pages").select(urls.canonical_host(urls.host(u)).alias("host"), urls.record_id(u, F.lit("20240101000000")).alias("id"))
    return pages.groupBy("host").agg(F.count("*").alias("n"), F.max("id").alias("last_id")).orderBy(F.desc("n"), "host").limit(10)


def _scratch(spark: SparkSession, name: str) -> str:
    """A new path in the warehouse, which the file system removes when the driver ends."""
    path = f"{spark.conf.get('spark.sql.warehouse.dir')}/{name}-{uuid.uuid4().hex}"
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(target)
    return path


def _archived(spark, sf) -> DataFrame:
    """The pages written as gzipped archives, every third body in one chunk, and read back as records."""
    line = lambda *parts: F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts], F.lit("\r\n"))
    chunked, size = F.col("page_id") % 3 == 0, F.octet_length("html")
    body = F.when(chunked, F.concat(F.lower(F.hex(size)), F.lit("\r\n"), F.col("html"), F.lit("\r\n0\r\n"))).otherwise(F.col("html"))
    block = F.concat(line("HTTP/1.1 ", (F.col("page_id") % 2 + 200).cast("string"), " OK"), line("Content-Type: text/html; charset=utf-8"), F.when(chunked, "Transfer-Encoding: chunked\r\n").otherwise(""), F.lit("\r\n"), body)
    head = F.concat(line("WARC/1.0"), line("WARC-Type: response"), line("WARC-Record-ID: <urn:x:", F.col("page_id").cast("string"), ">"), line("WARC-Target-URI: <", F.col("url"), ">"), line("WARC-Date: 2024-01-01T00:00:00Z"), line("Content-Length: ", F.octet_length("block").cast("string")))
    folder = _scratch(spark, "archives")
    pages = _t(spark, sf, "pages").withColumn("block", block)
    pages.select(F.concat(head, F.lit("\r\n"), F.col("block")).alias("value")).write.option("lineSep", "\r\n\r\n").option("compression", "gzip").text(folder)
    return captures.read(spark, folder).withColumn("page_id", F.regexp_extract(F.col("warc_headers")["WARC-Record-ID"], r"(\d+)", 1).cast("long"))


@query("SELECT page_id, 'response' AS record_type, url, (page_id % 2 + 200)::VARCHAR AS status, 'text/html; charset=utf-8' AS served, md5(html) AS md5 FROM pages")
def archive_records(spark, sf):
    rows = _archived(spark, sf)
    return rows.select("page_id", "record_type", "url", F.col("http_status").alias("status"), types.header(F.col("http_headers"), "content-type").alias("served"), F.md5("payload").alias("md5"))


_SHA = " || ".join(f"translate(to_base(('0x' || substr(h, {1 + 10 * k}, 10))::BIGINT, 32, 8), '0123456789ABCDEFGHIJKLMNOPQRSTUV', '{payload.BASE32}')" for k in range(4))


@query(f"SELECT page_id, 'sha1:' || {_SHA} AS hash, (page_id % 2 + 200)::INT AS status_code, '<urn:x:' || page_id || '>' AS record FROM (SELECT page_id, sha1(html) AS h FROM pages)")
def archive_digests(spark, sf):
    docs = documents(_archived(spark, sf))
    return docs.select("page_id", "hash", "status_code", F.concat(F.lit("<"), F.col("warc_key_id"), F.lit(">")).alias("record"))


@query(f"SELECT page_id FROM pages WHERE regexp_matches(lower({_PATH}), '^/?$|^/index\\.[a-z]+$') OR page_id % 5 = 0")
def slash_pages(spark, sf):
    pages = _t(spark, sf, "pages").withColumn("url", F.when(F.col("page_id") % 5 == 0, F.concat(F.regexp_extract("url", "^[a-z]+://[^/?#]*", 0), F.lit("/index.html"))).otherwise(F.col("url")))
    return documents(captures.from_pages(pages), slash_pages=True).select(F.col("offset").alias("page_id"))


_SUFFIXES = ["com.au", "co.jp", "*.ck", "!www.ck", "com", "org"]
_ENDS = ["com.au", "x.co.jp", "a.ck", "www.ck", "org", "unknown"]
_ENDED = "(SELECT page_id, regexp_replace(" + _HOST + ", '\\.[a-z]+$', '.') || " + repr(_ENDS) + "[(page_id % 6)::INT + 1] AS h FROM pages)"
_KNOWN = "[2, 2, 2, 1, 1, 1][(page_id % 6)::INT + 1]"
_TAIL = lambda n: f"array_to_string(list_slice(string_split(h, '.'), len(string_split(h, '.')) - {n} + 1, len(string_split(h, '.'))), '.')"


@query(f"SELECT page_id, {_TAIL(_KNOWN)} AS public_suffix, {_TAIL('(' + _KNOWN + ' + 1)')} AS domain FROM {_ENDED}")
def suffix_domains(spark, sf):
    end = F.element_at(F.array(*[F.lit(x) for x in _ENDS]), (F.col("page_id") % 6 + 1).cast("int"))
    rows = _t(spark, sf, "pages").select("page_id", F.concat(F.regexp_replace(urls.host(F.col("url")), r"\.[a-z]+$", "."), end).alias("host"))
    found = suffixes(rows, spark.createDataFrame([(x,) for x in _SUFFIXES], "rule string"))
    return rows.join(found, "host").select("page_id", "public_suffix", "domain")


@query(
    f"""SELECT page_id, array_to_string(list_sort(list_distinct(h)), '|') AS hosts, array_to_string(list_sort(list_distinct(list_transform(h, lambda x: string_split(x, '.')[-1]))), '|') AS suffixes
    FROM (SELECT page_id, list(regexp_replace(regexp_extract(link, '^[a-z]+://([^/?#]*)', 1), '^(www[0-9]*|ww2|ww)\\.', '')) AS h FROM {_LINKS} GROUP BY 1)"""
)
def linked_hosts(spark, sf):
    docs = documents(captures.from_pages(_t(spark, sf, "pages"))).where(F.size("links") > 0)
    joined = lambda c: F.array_join(F.array_sort(c), "|")
    return docs.select(F.col("offset").alias("page_id"), joined("links_hosts").alias("hosts"), joined("links_public_suffixes").alias("suffixes"))


@query(f"SELECT page_id, link, {_CANON.replace('url', 'link')} AS resolved FROM {_LINKS}")
def resolved_links(spark, sf):
    pages = _t(spark, sf, "pages").select("page_id", "url", F.regexp_extract("url", "^([a-z]+://[^/?#]*)", 1).alias("site"), F.explode(html.native_hrefs(F.col("html"))).alias("l"))
    return pages.select("page_id", F.concat("site", "l").alias("link"), urls.resolved_url("url", "l").alias("resolved"))


@query(f"SELECT page_id, CASE WHEN page_id % 4 = 0 THEN 'malformed.host' ELSE {_HOST} END AS host FROM pages")
def extracted_hosts(spark, sf):
    url = F.when(F.col("page_id") % 4 == 0, F.regexp_replace("url", "://", "://-")).otherwise(F.col("url"))
    return _t(spark, sf, "pages").select("page_id", urls.extract_host(url).alias("host"))


@query(
    """SELECT page_id, CASE page_id % 4 WHEN 0 THEN 404 WHEN 3 THEN 2001 ELSE 200 END::INT AS status,
    CASE page_id % 4 WHEN 1 THEN 'status isn''t a number: x' WHEN 3 THEN 'status out of range: 2001' END AS error FROM pages"""
)
def status_errors(spark, sf):
    m = F.col("page_id") % 4
    value = F.when(m == 0, "404").when(m == 1, "x").when(m == 3, "2001")
    return _t(spark, sf, "pages").select("page_id", types.status(value).alias("status"), types.status_error(value).alias("error"))


@query(
    """SELECT p_partkey, CASE WHEN p_partkey % 7 = 0 THEN 'application/x-empty' WHEN p_partkey % 3 = 0 THEN 'text/html; v=5' WHEN p_partkey % 3 = 1 THEN 'application/pdf'
    WHEN p_partkey % 2 = 0 THEN 'text/served' ELSE 'application/octet-stream' END AS chosen FROM part"""
)
def chosen_types(spark, sf):
    k = F.col("p_partkey")
    detected = F.when(k % 3 == 0, "text/html").when(k % 3 == 1, "application/pdf").otherwise("application/octet-stream")
    signature = F.when(k % 3 == 0, "text/html; v=5").when(k % 3 == 1, "application/x")
    none = F.lit(None).cast("string")
    length = F.when(k % 7 == 0, 0).otherwise(5)
    chosen = types.choose(detected, F.when(k % 3 == 2, "application/octet-stream").otherwise(signature), none, F.when(k % 2 == 0, "text/served"), none, length, F.lit(False))
    return _t(spark, sf, "part").select("p_partkey", chosen.alias("chosen"))


@query("SELECT p_partkey, (p_size * 3)::BIGINT AS height, (p_size + 7)::BIGINT AS width, (p_size * 3 * (p_size + 7))::BIGINT AS size FROM part")
def image_sizes(spark, sf):
    four = lambda n: F.lpad(F.hex(n), 8, "0")
    head = F.unhex(F.concat(F.lit("89504E470D0A1A0A0000000D49484452"), four(F.col("p_size") + 7), four(F.col("p_size") * 3)))
    return _t(spark, sf, "part").select("p_partkey", images.measured(head).alias("m")).select("p_partkey", "m.*")


@query(r"SELECT doc_id, md5(ltrim(regexp_replace(regexp_replace(t, '[ \t]*\n[ \t\n]*', chr(10), 'g'), '[ \t]+', ' ', 'g'), ' ')) AS md5 FROM (SELECT doc_id, '  ' || text || chr(9) || ' ' || chr(10) || ' ' || chr(10) || 'x' AS t FROM documents)")
def trimmed_space(spark, sf):
    t = F.concat(F.lit("  "), F.col("text"), F.lit("\t \n \nx"))
    return _t(spark, sf, "documents").select("doc_id", F.md5(text.trim_space(t).cast("binary")).alias("md5"))


@query("SELECT p_partkey, array_to_string(list_sort(CASE WHEN p_size % 2 = 0 THEN [p_brand, p_type] ELSE [p_brand] END), '|') AS generator FROM part")
def generator_names(spark, sf):
    png = F.when(F.col("p_size") % 2 == 0, F.concat(F.lit("keyword=Software, value="), F.col("p_type")))
    return _t(spark, sf, "part").select("p_partkey", F.array_join(F.array_sort(text.generators(F.col("p_brand"), png, F.col("p_brand"))), "|").alias("generator"))


@query("SELECT c_custkey, c_custkey % 2 = 0 AS good FROM customer")
def strict_postcodes(spark, sf):
    k = F.col("c_custkey")
    right = F.element_at(F.array(*[F.lit(x) for x in ("SW1A 1AA", "m11ae", "cr2  6XH", "GIR 0AA", "gir0aa", "DN55 1pt", "w1a 0ax")]), (k % 7 + 1).cast("int"))
    wrong = F.element_at(F.array(*[F.lit(x) for x in ("QQ1 1AA", "SW1A 1CC", "SW1A", "1AA SW1", "SW1A-1AA")]), (k % 5 + 1).cast("int"))
    return _t(spark, sf, "customer").select("c_custkey", text.is_postcode(F.when(k % 2 == 0, right).otherwise(wrong)).alias("good"))


@query("SELECT event_id, CASE WHEN event_id % 9 = 0 THEN 'unknown' ELSE year(ts)::VARCHAR END AS year, strftime(CASE WHEN event_id % 3 = 0 THEN ts ELSE ts - INTERVAL 1 DAY END, '%Y-%m-%d') AS modified FROM events")
def years_and_changes(spark, sf):
    year = dates.year_of(F.when(F.col("event_id") % 9 == 0, "0000-00").otherwise(F.date_format("ts", "yyyyMMddHHmmss")))
    day = F.expr("ts - interval 1 day")
    changed = dates.last_modified(F.expr("ts - interval 2 day"), day, F.when(F.col("event_id") % 3 == 0, F.col("ts")))
    return _t(spark, sf, "events").select("event_id", year.alias("year"), F.date_format(changed, "yyyy-MM-dd").alias("modified"))


@query("SELECT doc_id, array_to_string(list_sort(list_distinct([lang, source, 'x'])), '|') AS merged, array_to_string(list_sort(list_distinct([lang, 'a', 'b'])), '|') AS dates FROM documents WHERE lang IS NOT NULL AND source IS NOT NULL")
def merged_values(spark, sf):
    docs = _t(spark, sf, "documents").where("lang is not null and source is not null")
    merged = fields.merge(F.array("lang", "source"), F.array("source", F.lit("x")))
    days = annotate.merged_dates(F.col("lang"), F.array(F.lit("b"), F.lit("a"), F.lit("b")))
    return docs.select("doc_id", F.array_join(F.array_sort(merged), "|").alias("merged"), F.array_join(days, "|").alias("dates"))


@query(
    f"""SELECT page_id, 'root' AS scope, 'B' AS collection FROM pages WHERE starts_with(url, 'http://t') UNION ALL
    SELECT page_id, 'root', 'E' FROM pages WHERE starts_with(url, 'https://') UNION ALL SELECT page_id, 'subdomains', 'C' FROM pages WHERE regexp_replace({_HOST}, '^(www[0-9]*|ww2|ww)\\.', '') IN ('net', 'example.net')"""
)
def prefix_updates(spark, sf):
    given = [("root", "http://t", "B", ["B"], ["s"]), ("root", "https://", "E", ["E"], ["s"]), ("subdomains", "example.net", "C", ["C"], ["s"])]
    rules_ = spark.createDataFrame(given, "scope string, key string, collection string, collections array<string>, subject array<string>")
    pages = _t(spark, sf, "pages").select(F.col("page_id").alias("id"), "url", F.lit("f").alias("source_file"))
    return annotate.prefix_updates(pages, rules_).select(F.col("id").alias("page_id"), "scope", "collection")


@query("SELECT scope, key, collection, array_to_string(collections, '|') AS collections FROM (VALUES " + ", ".join(f"('{s}', '{k}', '{c}', {cs!r})" for s, k, c, cs, _ in _RULES) + ") v(scope, key, collection, collections)")
def annotation_file(spark, sf):
    given = spark.createDataFrame(_RULES, "scope string, key string, collection string, collections array<string>, subject array<string>")
    ranges = spark.createDataFrame([("A", None, None)], "collection string, start timestamp, end timestamp")
    folder = _scratch(spark, "annotations")
    rules.write_annotations(given, ranges, folder)
    return rules.annotations(spark, folder)[0].select("scope", "key", "collection", F.array_join("collections", "|").alias("collections"))


@query("SELECT DISTINCT url AS prefix FROM pages WHERE page_id % 2 = 0")
def prefix_file(spark, sf):
    folder = _scratch(spark, "prefixes")
    lines = _t(spark, sf, "pages").where("page_id % 2 = 0").select(F.explode(F.array(F.concat(F.lit(" "), F.col("url")), F.lit("# no"), F.lit(""))).alias("value"))
    lines.write.text(folder)
    return rules.prefixes(spark, folder)


@query("SELECT doc_id, source, md5(text) AS md5 FROM documents WHERE text IS NOT NULL")
def xml_roundtrip(spark, sf):
    folder = _scratch(spark, "xml")
    docs = _t(spark, sf, "documents").where("text is not null")
    sinks.write_xml(docs.select("doc_id", "source", F.base64(F.col("text").cast("binary")).alias("body")), folder)
    value = lambda n: F.get(F.filter("fields", lambda f: f["name"] == n), F.lit(0))["value"]
    return sinks.read_xml(spark, folder).select(value("doc_id").cast("long").alias("doc_id"), value("source").alias("source"), F.md5(F.unbase64(value("body"))).alias("md5"))


@query("SELECT doc_id::VARCHAR AS id, source, 'other' AS kind, len(string_split(lang, 'e'))::BIGINT AS n FROM documents WHERE lang IS NOT NULL AND source IS NOT NULL")
def bulk_documents(spark, sf):
    docs = _t(spark, sf, "documents").where("lang is not null and source is not null")
    docs = docs.select(F.col("doc_id").cast("string").alias("id"), "source", F.lit("").alias("content_type_norm"), F.split("lang", "e").alias("parts"))
    parsed = F.from_json("body", "source array<string>, content_type_norm array<string>, parts array<string>, index_time array<string>").alias("b")
    rows = sinks.bulk_document(docs).select("_id", parsed).where("size(b.index_time) = 1")
    return rows.select(F.col("_id").alias("id"), F.col("b.source")[0].alias("source"), F.col("b.content_type_norm")[0].alias("kind"), F.size("b.parts").cast("long").alias("n"))


@query("SELECT page_id, url || chr(9) || '20240101' || chr(9) || 'face-a face-b' AS line FROM pages WHERE page_id % 3 = 0")
def face_lines(spark, sf):
    faces = F.when(F.col("page_id") % 3 == 0, F.array(F.lit("face-b"), F.lit("hat"), F.lit("face-a"))).otherwise(F.array(F.lit("hat")))
    return _t(spark, sf, "pages").select("page_id", sinks.face_line(faces, "face-", F.col("url"), F.lit("20240101")).alias("line")).where("line is not null")


@query("SELECT page_id, page_id % 100 + 1 AS answer FROM pages")
def enriched(spark, sf):
    rows = _t(spark, sf, "pages").select("page_id", (F.col("page_id") % 100).cast("string").alias("asked"))
    got = enrich(rows, {"asked": "number"}, {"next": "answer"}, lambda q: {"next": q["number"] + 1})
    return got.select("page_id", F.col("answer").cast("long").alias("answer"))


@query("SELECT c_custkey, len(n)::BIGINT AS n, list_min(n) AS low FROM (SELECT c_custkey, list_concat([substr(s, i, 2) FOR i IN range(1, length(s))], [substr(s, i, 3) FOR i IN range(1, length(s) - 1)]) AS n FROM (SELECT c_custkey, lower(c_mktsegment) AS s FROM customer))")
def name_ngrams(spark, sf):
    grams = _t(spark, sf, "customer").select("c_custkey", text.ngrams(F.lower("c_mktsegment"), 2, 3).alias("g"))
    return grams.select("c_custkey", F.size("g").cast("long").alias("n"), F.array_min("g").alias("low"))


@query(f"SELECT page_id, array_to_string(list_transform(range(1, len(p) + 1), lambda i: array_to_string(list_slice(p, 1, i), '/')), '|') AS levels FROM (SELECT page_id, list_filter(string_split({_PATH}, '/'), lambda x: x != '') AS p FROM pages)")
def path_levels(spark, sf):
    return _t(spark, sf, "pages").select("page_id", F.array_join(text.path_levels(urls.path(F.col("url"))), "|").alias("levels"))


@query("SELECT page_id, starts_with(t, 'text/css') OR starts_with(t, 'text/javascript') AS script FROM (SELECT page_id, CASE page_id % 3 WHEN 0 THEN 'text/css; x' WHEN 1 THEN 'text/javascript' ELSE 'text/html' END AS t FROM pages)")
def script_types(spark, sf):
    m = F.col("page_id") % 3
    t = F.when(m == 0, "text/css; x").when(m == 1, "text/javascript").otherwise("text/html")
    return _t(spark, sf, "pages").select("page_id", types.has_script_type(t).alias("script"))


@query(f"SELECT id, {_HOST} AS host FROM (SELECT DISTINCT '20240101000000/' || to_base64(unhex(md5(url))) AS id, url FROM pages)")
def streamed_documents(spark, sf):
    folder, out = _scratch(spark, "stream"), _scratch(spark, "streamed")
    captures.from_pages(_t(spark, sf, "pages")).write.parquet(folder)
    records_ = spark.readStream.schema(spark.read.parquet(folder).schema).parquet(folder)
    write_stream(stream_documents(records_).select("id", "host"), out, f"{out}-state").awaitTermination()
    return spark.read.parquet(out)


@query("SELECT p_partkey, CASE WHEN p_size % 3 = 0 THEN 'http://ns.example/' || p_size || '#root' END AS ns FROM part")
def xml_roots(spark, sf):
    size = F.col("p_size").cast("string")
    named = F.concat(F.lit('<?xml version="1.0"?><!-- c --><a:Root xmlns:a="http://NS.example/'), size, F.lit('"><b/></a:Root>'))
    body = F.when(F.col("p_size") % 3 == 0, named).when(F.col("p_size") % 3 == 1, "<root>").otherwise("no xml")
    return _t(spark, sf, "part").select("p_partkey", types.root_namespace(body.cast("binary")).alias("ns"))


@query("SELECT 'gzip: ' || user_id % 5 AS error, count(*) AS n FROM events WHERE event_id % 2 = 0 GROUP BY 1")
def distinct_errors(spark, sf):
    error = F.concat(F.lit("gzip: "), (F.col("user_id") % 5).cast("string"))
    docs = _t(spark, sf, "events").select(F.when(F.col("event_id") % 2 == 0, "pdf").otherwise("html").alias("content_type_norm"), F.array(error).alias("parse_error"))
    return summaries.distinct_errors(docs, kind="pdf")


@query("SELECT count(*) FILTER (p_size % 2 = 0) AS images, count(*) FILTER (p_size % 4 = 0) AS measured FROM part")
def sampled_images(spark, sf):
    size = F.when(F.col("p_size") % 4 == 0, 5)
    return summaries.sampled_images(_t(spark, sf, "part").select(F.when(F.col("p_size") % 2 == 0, "image").otherwise("html").alias("content_type_norm"), size.alias("image_size")))


@query("SELECT n_nationkey, array_to_string(list_concat(CASE WHEN r_name = 'ASIA' THEN ['asia', 'orient', 'east'] ELSE string_split_regex(lower(r_name), '[^a-z0-9]+') END, string_split_regex(lower(n_name), '[^a-z0-9]+')), '|') AS terms FROM nation JOIN region ON n_regionkey = r_regionkey WHERE NOT contains(n_name, ' ') AND NOT contains(r_name, ' ')")
def synonym_terms(spark, sf):
    rows = _t(spark, sf, "nation").join(F.broadcast(_t(spark, sf, "region")), F.col("n_regionkey") == F.col("r_regionkey")).where("not contains(n_name, ' ') and not contains(r_name, ' ')")
    return rows.select("n_nationkey", F.array_join(text.terms(F.concat_ws(" / ", "r_name", "n_name"), {"asia": ["orient", "east"]}), "|").alias("terms"))
