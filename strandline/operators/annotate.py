"""Annotations of captures by joins with rule tables.

Rules are (scope, key, collection, collections, subject); ranges are (collection, start, end). Prefix and suffix rules are
equality joins on exploded candidates, so no join compares every capture with every rule.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandline.functions import text as T
from strandline.functions import urls

#: Rules that are joined by broadcasting; with more, Spark chooses.
SMALL = 100_000


def _rules(rules: DataFrame) -> DataFrame:
    return F.broadcast(rules) if rules.count() <= SMALL else rules


def matches(captures: DataFrame, rules: DataFrame, id_col: str = "id") -> DataFrame:
    """(id, scope, collection, collections, subject) for each rule that fits captures (id, url, source_file)."""
    own = ["collection", "collections", "subject"]
    base = captures.select(F.col(id_col).alias("id"), "url", "source_file")
    of = {s: _rules(rules.where(F.col("scope") == s).select("scope", "key", *own)) for s in ("resource", "root", "source_file_matches")}
    equal = [base.join(of[s], F.col("url") == F.col("key")).select("id", "scope", *own) for s in ("resource", "root")]
    sub = rules.where(F.col("scope") == "subdomains").withColumn("level", F.explode(urls.host_levels(F.col("key")))).select("scope", "level", *own)
    host = base.select("id", urls.canonical_host(urls.host(F.col("url"))).alias("level"))
    below = host.join(_rules(sub), "level").select("id", "scope", *own)
    names = base.select("source_file").distinct().join(of["source_file_matches"], F.expr("source_file rlike key"))  # few names, each tried once
    source = base.join(names, "source_file").select("id", "scope", *own)
    return equal[0].union(equal[1]).union(below).union(source)


def annotate(captures: DataFrame, rules: DataFrame, ranges: DataFrame, id_col: str = "id", time_col: str = "crawl_date") -> DataFrame:
    """captures with the arrays ``collections`` and ``wct_subjects`` and the last ``collection``.

    A collection counts only if it has a range that the capture's time lies strictly inside; subjects aren't tested.
    """
    found = matches(captures, rules, id_col).join(captures.select(F.col(id_col).alias("id"), F.col(time_col).alias("at")), "id")
    far, near = F.lit("9999-12-30 23:59:59.999").cast("timestamp"), F.lit("1970-01-01 00:00:00").cast("timestamp")
    spans = ranges.select(F.col("collection").alias("name"), F.coalesce("start", near).alias("start"), F.coalesce("end", far).alias("end"))
    each = found.select("id", "at", F.explode(F.array_union("collections", F.array("collection"))).alias("name"))
    inside = each.join(_rules(spans), "name").where((F.col("start") < F.col("at")) & (F.col("at") < F.col("end")))
    sets = inside.groupBy("id").agg(F.array_sort(F.collect_set("name")).alias("collections"))
    main = found.select("id", F.col("collection").alias("name")).distinct().join(inside.select("id", "name").distinct(), ["id", "name"]).groupBy("id").agg(F.max("name").alias("collection"))
    subjects = found.select("id", F.explode("subject").alias("s")).groupBy("id").agg(F.array_sort(F.collect_set("s")).alias("wct_subjects"))
    out = captures.join(sets.withColumnRenamed("id", id_col), id_col, "left").join(main.withColumnRenamed("id", id_col), id_col, "left")
    return out.join(subjects.withColumnRenamed("id", id_col), id_col, "left")


def surt_url(url):
    """http://(org,example,www,)/path"""
    host = urls.host(url)
    return F.concat(urls.scheme(url), F.lit("://"), urls.surt(host), F.lit(")"), urls.path(url))


def _prefix_hits(rows: DataFrame, key: str, prefixes: DataFrame, id_col: str) -> DataFrame:
    """Ids of rows whose key begins with a prefix: one candidate for each length that occurs."""
    lengths = sorted(r[0] for r in prefixes.select(F.length("prefix")).distinct().collect() if r[0])  # at most the longest url
    if not lengths:
        return rows.select(id_col).limit(0)
    candidate = F.explode(F.array_distinct(F.array(*[F.substring(key, 1, n) for n in lengths]))).alias("prefix")
    return rows.select(id_col, candidate).join(_rules(prefixes.distinct()), "prefix", "left_semi").select(id_col).distinct()


def access_terms(captures: DataFrame, prefixes: DataFrame, id_col: str = "id") -> DataFrame:
    """captures with ``access_terms``: OA where the reversed-host url begins with a prefix, else RRO."""
    keyed = captures.select(id_col, surt_url(F.col("url")).alias("key"))
    hits = _prefix_hits(keyed, "key", prefixes, id_col).withColumn("open", F.lit(True))
    return captures.join(hits, id_col, "left").withColumn("access_terms", F.when(F.col("open"), "OA").otherwise("RRO")).drop("open")


def excluded(captures: DataFrame, prefixes: DataFrame, id_col: str = "id") -> DataFrame:
    """Ids of captures whose url, free of scheme and www, begins with a prefix of the list."""
    bare = lambda c: F.regexp_replace(F.lower(c), r"^(https?://)?(www\d*\.)?", "")
    keyed = captures.select(id_col, bare(F.col("url")).alias("key"))
    return _prefix_hits(keyed, "key", prefixes.select(bare(F.col("prefix")).alias("prefix")), id_col)


def not_excluded(captures: DataFrame, prefixes: DataFrame, id_col: str = "id") -> DataFrame:
    """captures without the excluded ones."""
    return captures.join(excluded(captures, prefixes, id_col), id_col, "left_anti")


def scope_key(scope, url):
    """The key of a rule by scope: the url, its scheme and host, or its host; null for other scopes."""
    host = urls.host(url)
    return F.when(scope == "resource", url).when(scope == "root", F.concat(urls.scheme(url), F.lit("://"), host)).when(scope == "subdomains", host)


def taxonomy(terms: DataFrame) -> DataFrame:
    """(id, path) of terms (id, parent, name, published): names from the root down, joined by bars. Unpublished roots leave out their branch.

    A level at a time until none is left; terms that no root reaches have no path.
    """
    live = terms.where("parent is not null or published").select("id", "parent", F.col("name").alias("path"))
    done = live.where("parent is null").select("id", "path")
    rest, level = live.where("parent is not null"), done
    while True:
        level = rest.alias("c").join(level.alias("p"), F.col("c.parent") == F.col("p.id")).select("c.id", F.concat_ws("|", "p.path", "c.path").alias("path"))
        if level.isEmpty():
            return done
        done = done.union(level)


def located(docs: DataFrame, districts: DataFrame, id_col: str = "id", districts_col: str = "postcode_district") -> DataFrame:
    """docs with ``locations``: sorted ``lat,lon`` of their districts (district, lat, lon)."""
    place = T.location(F.col("lat"), F.col("lon"))
    each = docs.select(id_col, F.explode(districts_col).alias("district")).join(_rules(districts), "district")
    found = each.groupBy(id_col).agg(F.array_sort(F.collect_set(place)).alias("locations"))
    return docs.join(found, id_col, "left")


def merged_dates(crawled: Column, earlier: Column) -> Column:
    """All dates of a resource, once each and in order, from this capture's and those already known."""
    none = F.array().cast("array<string>")
    return F.array_sort(F.array_union(F.array(crawled), F.coalesce(earlier, none)))


def prefix_updates(docs: DataFrame, rules: DataFrame, id_col: str = "id") -> DataFrame:
    """(id, scope, collection, collections, subject): what the updater applies to documents that are already there.

    Its rules of the scope root are prefixes of the url, unlike those at indexing; the others are as in ``matches``.
    """
    own = ["collection", "collections", "subject"]
    root = rules.where("scope = 'root'")
    lengths = sorted(r[0] for r in root.select(F.length("key")).distinct().collect() if r[0])  # at most the longest url
    rest = matches(docs, rules.where("scope != 'root'"), id_col)
    if not lengths:
        return rest
    candidate = F.explode(F.array_distinct(F.array(*[F.substring("url", 1, n) for n in lengths]))).alias("key")
    found = docs.select(F.col(id_col).alias("id"), candidate).join(_rules(root), "key").select("id", "scope", *own)
    return rest.union(found)


