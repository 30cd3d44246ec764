"""URL rules whose decisions reach aliases over redirects and canonical links.

A rule is (host, path, verdict); it fits a host and its subdomains where the url's path starts with the rule's, and
the longest rule that fits decides. Rules are a short list that becomes part of the plan, or a table of any length that is joined
on the url's host and its parents. A url that no rule fits takes the decision of its aliases: the connected
component over meta-refresh redirects, canonical links and, if given, a table of redirects, whose urls are judged by the
rules whether they are pages here or not, with urls that differ only in scheme, fragment, trailing slash or tracking parameters as one node. All links of a page count, relative ones against its
``<base>`` if it has one, with ``.`` and ``..`` resolved. One explicit allow among the aliases outweighs any number of
blocks; without either the url is allowed.

Nulls: a null url or one without ``://`` has empty host and path, fits no rule, has no aliases and is allowed. Null
html has no links. Of two rules of a length the later one decides in a list, the one with allow in a table. Repeated rows get the same
verdict. Other columns are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandline.llm._common import SPACE, cut
from strandline.llm._components import components

Rule = tuple[str, str, str]
#: Parameters that say where a visitor came from.
TRACKING = "(?i)(?<=^|&)(utm_[a-z]+|ref|fbclid|gclid)=[^&]*"
#: Entities that occur in urls; the ampersand comes last, so nothing is read twice.
ENTITIES = {"lt": "<", "gt": ">", "quot": "\"", "apos": "'", "#39": "'", "#x27": "'", "#34": "\"", "#38": "&", "#x26": "&", "amp": "&"}


def ascii_lower(s: Column) -> Column:
    return F.translate(s, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def after_scheme(url: Column) -> Column:
    at = F.locate("://", url)
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")


def host_and_path(url: Column) -> tuple[Column, Column]:
    rest = F.coalesce(after_scheme(url), F.lit(""))
    host = F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)
    return ascii_lower(host), path


def match(host: Column, path: Column, rules: Sequence[Rule]) -> tuple[Column, Column]:
    """Text and verdict of the longest rule that fits, else null. rules is a short list that becomes part of the plan."""
    text = verdict = F.lit(None).cast("string")
    for h, p, v in sorted(rules, key=lambda r: len(r[0] + r[1])):  # the last branch put in front is the longest
        fits = ((host == h) | host.endswith(f".{h}")) & path.startswith(p)
        text, verdict = F.when(fits, f"{h}{p}").otherwise(text), F.when(fits, v).otherwise(verdict)
    return text, verdict


def with_node(df: DataFrame, url: str, name: str) -> DataFrame:
    """df with a hash of what urls of one page have in common; null without ``://``. Step by step, so no expression is repeated."""
    own = [F.col(f"`{c}`") for c in df.columns]
    df = df.select(*own, F.regexp_replace(after_scheme(F.col(url)), r"(?s)#.*$", "").alias("_rest"))
    df = df.select(*own, F.regexp_extract("_rest", r"(?s)^([^/?]*)", 1).alias("_host"), F.regexp_extract("_rest", r"(?s)^[^/?]*([^?]*)", 1).alias("_path"), F.regexp_extract("_rest", r"(?s)\?(.*)$", 1).alias("_query"))
    query = F.btrim(F.regexp_replace(F.regexp_replace("_query", TRACKING, ""), "&&+", "&"), F.lit("&"))
    key = F.concat_ws("\n", ascii_lower(F.col("_host")), F.regexp_replace("_path", "/+$", ""), query)
    return df.select(*own, F.when(F.locate("://", F.col(url)) > 0, F.xxhash64(key)).alias(name))


def match_table(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """(url, rule, verdict) of the longest rule that fits, for urls (url, host, path) and rules (host, path, verdict) of any number.

    Urls meet the rules of their host and of each parent of it; the rules are broadcast if Spark finds them small, and else hosts that many urls share are
    Spark's to split.
    """
    labels = F.split("host", r"\.")
    parents = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    of = urls.where("host != ''").select("url", "path", F.explode(parents).alias("host"))
    given = rules.select("host", F.col("path").alias("begins"), "verdict").distinct()
    fits = of.join(given, "host").where(F.col("path").startswith(F.col("begins")))
    text = F.concat("host", "begins")
    best = F.max(F.struct(F.length(text).alias("n"), (F.col("verdict") == "allow").alias("allow"), text.alias("rule"), "verdict")).alias("best")
    return fits.groupBy("url").agg(best).select("url", "best.rule", "best.verdict")


def plain_link(link: Column) -> Column:
    """A link without the entities of html and the white space around it."""
    for name, char in ENTITIES.items():
        link = F.regexp_replace(link, f"(?i)&{name};", char)
    return F.btrim(link, F.lit(SPACE))


def resolved_path(url: Column) -> Column:
    """url with the segments ``.`` and ``..`` of its path resolved."""
    site, rest = F.regexp_extract(url, r"(?s)^([^:/?#]+://[^/?#]*)", 1), F.regexp_extract(url, r"(?s)^[^:/?#]+://[^/?#]*(/[^?#]*)", 1)
    tail = F.regexp_extract(url, r"(?s)^[^?#]*([?#].*)$", 1)
    parts = F.split(F.substring(rest, 2, 1 << 30), "/")
    none = F.array().cast("array<string>")
    step = lambda a, s: F.when(s == "..", F.slice(a, F.lit(1), F.greatest(F.size(a) - 1, F.lit(0)))).when(s == ".", a).otherwise(F.concat(a, F.array(s)))
    ends = F.when(rest.rlike(r"/\.{1,2}$"), "/").otherwise("")
    path = F.regexp_replace(F.concat(F.lit("/"), F.array_join(F.aggregate(parts, none, step), "/"), ends), "^//$", "/")
    return F.when(rest.rlike(r"/\.{1,2}(/|$)"), F.concat(site, path, tail)).otherwise(url)


def absolute(base: Column, link: Column) -> Column:
    """The absolute form of a link: with scheme, with host, from the root, a query alone, or beside the base."""
    site, bare = F.regexp_extract(base, r"(?s)^([^:/?#]+://[^/?#]*)", 1), F.regexp_replace(base, r"(?s)[?#].*$", "")
    folder = F.regexp_extract(bare, r"(?s)^[^:/?#]+://[^/]*(/.*/|/)", 1)
    beside = F.concat(site, F.when(folder == "", "/").otherwise(folder), link)
    out = F.when(link == "", None).when(link.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), link).when(link.startswith("//"), F.concat(F.substring_index(site, "//", 1), link))
    return out.when(link.startswith("/"), F.concat(site, link)).when(link.startswith("?"), F.concat(bare, link)).otherwise(beside)


def page_links(pages: DataFrame) -> DataFrame:
    """(source, target): the urls that each page's canonical links and meta refreshes join."""
    html = F.col("html")
    tags = lambda pattern: F.regexp_extract_all("html", F.lit(pattern), F.lit(0))
    found = pages.where(html.rlike("(?i)canonical|refresh")).select(
        "url",
        plain_link(F.regexp_extract(html, r"(?is)<base\b[^>]*?\bhref\s*=\s*[\"']?([^\"'\s>]+)", 1)).alias("base"),
        F.explode(F.concat(tags(r"(?is)<link\b[^>]*\brel\s*=\s*[\"']?canonical\b[^>]*>"), tags(r"(?is)<meta\b[^>]*\bhttp-equiv\s*=\s*[\"']?refresh\b[^>]*>"))).alias("tag"),
    )
    href = F.regexp_extract("tag", r"(?is)\bhref\s*=\s*[\"']?([^\"'\s>]+)", 1)
    goes = F.regexp_extract("tag", r"(?is)\burl\s*=\s*[\"']?([^\"'\s>]+)", 1)
    found = found.select("url", "base", plain_link(F.when(F.col("tag").rlike("(?i)^<link"), href).otherwise(goes)).alias("link"))
    found = cut(found.where("link != ''"))
    found = cut(found.select("url", F.coalesce(absolute(F.col("url"), F.col("base")), "url").alias("base"), "link"))
    return cut(found.select(F.col("url").alias("source"), resolved_path(absolute(F.col("base"), F.col("link"))).alias("target")))


def edges(df: DataFrame, source: str, target: str) -> DataFrame:
    """Edges (a, b) between the nodes of two urls. Cut before anything is filtered: a filter pushed down would repeat the expressions."""
    return cut(with_node(with_node(cut(df.select(source, target)), source, "a"), target, "b").select("a", "b"))


def _matched(urls: DataFrame, rules: Sequence[Rule] | DataFrame) -> DataFrame:
    """urls (url, ...) with host, path, rule and own, the rule's verdict."""
    host, path = host_and_path(F.col("url"))
    split = urls.withColumns({"host": host, "path": path})
    if not isinstance(rules, DataFrame):
        rule, verdict = match(F.col("host"), F.col("path"), rules)
        return split.withColumns({"rule": rule, "own": verdict})
    split = cut(split)
    found = match_table(split.select("url", "host", "path").distinct(), rules)
    return split.join(found.withColumnRenamed("verdict", "own"), "url", "left")


def judge(pages: DataFrame, rules: Sequence[Rule] | DataFrame, redirects: DataFrame | None = None) -> DataFrame:
    """page_id, host, path, rule, verdict for pages (page_id, url, html); redirects has source and target urls."""
    split = _matched(pages.select("page_id", "url"), rules)
    own = with_node(split.select("page_id", "url", "host", "path", "rule", "own"), "url", "node").drop("url")
    links = page_links(pages)
    if redirects is not None:
        links = links.union(redirects.select("source", "target"))
    far = _matched(links.select(F.explode(F.array("source", "target")).alias("url")).distinct(), rules)
    ruled = own.select("node", "own").union(with_node(far.select("url", "own"), "url", "node").select("node", "own"))
    known = components(edges(links, "source", "target"))
    label = F.coalesce("component", "node").alias("label")
    marks = ruled.where("own is not null").groupBy("node").agg(F.max(F.col("own") == "allow").alias("allow"), F.max(F.col("own") == "block").alias("block"))
    marks = marks.join(known, "node", "left").groupBy(label).agg(F.max("allow").alias("allow"), F.max("block").alias("block")).where("label is not null")
    open_nodes = own.where("own is null and node is not null").select("node").distinct().join(known, "node", "left").select("node", label)
    found = cut(open_nodes.join(marks, "label").select("node", F.when(F.col("allow"), "allow").when(F.col("block"), "block").alias("inherited")))
    out = own.join(found, "node", "left")
    return out.select("page_id", "host", "path", "rule", F.coalesce("own", "inherited", F.lit("allow")).alias("verdict"))
