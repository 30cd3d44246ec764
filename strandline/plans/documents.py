"""From capture records to documents: one narrow plan whose only Python is Arrow-batched, then joins with the rule tables that are given."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandline.config import DEFAULT, Config
from strandline.functions import dates, html, images, payload, text, trigrams, types, urls
from strandline.functions.fields import adjust, adjust_values
from strandline.operators import annotate, records
from strandline.operators.suffixes import suffixes


@dataclass(frozen=True)
class Tables:
    """Rule tables of a run; what isn't given isn't applied."""

    exclusions: DataFrame | None = None
    annotations: DataFrame | None = None
    ranges: DataFrame | None = None
    open_surts: DataFrame | None = None
    profiles: DataFrame | None = None
    suffixes: DataFrame | None = None
    districts: DataFrame | None = None


@dataclass(frozen=True)
class Analyser:
    """New columns from the frame, by name, for documents of some general kinds (all if none is named), if the settings ask for it."""

    columns: Callable[[Config], dict[str, Column]]
    kinds: tuple[str, ...] = ()
    enabled: Callable[[Config], bool] = lambda config: True

    def apply(self, docs: DataFrame, config: Config) -> DataFrame:
        if not self.enabled(config):
            return docs
        fits = F.col("content_type_norm").isin(*self.kinds) if self.kinds else F.lit(True)
        return docs.withColumns({name: F.when(fits, c) for name, c in self.columns(config).items()})


_ANALYSERS: list[Analyser] = []


def register(analyser: Analyser) -> Analyser:
    """Add an analyser that runs after the built-in ones."""
    _ANALYSERS.append(analyser)
    return analyser


def identify(captures: DataFrame, config: Config = DEFAULT) -> DataFrame:
    """Ids, url and host fields, dates and header fields."""
    url = F.col("url")
    error = types.status_error(F.col("http_status"))
    captures = captures.withColumn("parse_error", F.when(error.isNotNull(), F.concat(F.coalesce("parse_error", F.array().cast("array<string>")), F.array(error))).otherwise(F.col("parse_error")))
    sane = lambda c: F.when(error.isNull(), c)  # noqa: E731  no header of a bad status is taken
    out = captures.withColumns({"_ts": dates.wayback_time(F.col("warc_date")), "host": urls.host(url), "resourcename": urls.resource_name(url)})
    out = out.withColumns(
        {
            "id": urls.record_id(url, dates.digits(F.col("warc_date"))),
            "url_path": urls.path(url),
            "url_type": urls.url_type(url),
            "host_surt": urls.host_surts(F.col("host")),
            "domain": urls.domain(F.col("host")),
            "public_suffix": urls.public_suffix(F.col("host")),
            "content_type_ext": urls.extension(F.col("resourcename")),
            "crawl_date": dates.crawl_date(F.col("_ts")),
            "crawl_year": F.year("_ts"),
            "wayback_date": dates.wayback_date(F.col("_ts")),
            "warc_key_id": urls.strip_brackets(F.try_element_at("warc_headers", F.lit("WARC-Record-ID"))),
            "warc_ip": F.try_element_at("warc_headers", F.lit("WARC-IP-Address")),
            "status_code": types.status(F.col("http_status")),
            "content_type_served": sane(F.substring(types.header(F.col("http_headers"), "Content-Type"), 1, 200)),
            "server": sane(F.transform(F.filter("http_headers", lambda h: F.lower(h["name"]).isin("server", "x-powered-by")), lambda h: h["value"])),
            "redirect_to_norm": F.substring(urls.resolved_url(url, sane(types.header(F.col("http_headers"), "Location"))), 1, 2048),
        }
    )
    return out.withColumn("url_norm", urls.canonical_url(url)) if config.normalise_links else out


def _meta(name: str) -> Column:
    return F.try_element_at("_html.meta", F.lit(name))


def _position(name: str, separator: str) -> Column:
    part = lambda i: text.degrees(F.trim(F.split_part(_meta(name), F.lit(separator), F.lit(i))))
    return text.location(part(1), part(2))


def analyse(captures: DataFrame, config: Config = DEFAULT) -> DataFrame:
    """Payload fields: digests, first bytes, types, and for HTML its features and what follows from its links."""
    body, length = F.col("payload"), F.octet_length("payload").cast("long")
    revisit = F.col("record_type") == "revisit"
    served = types.bare(F.col("content_type_served"))
    declared = payload.digest_base32(F.try_element_at("warc_headers", F.lit("WARC-Payload-Digest")))
    computed = F.col("payload_digest")
    out = captures.withColumns({"content_length": F.when(~revisit, length), "hash": payload.chosen_digest(F.col("record_type"), computed, declared), "hash_matched": payload.digest_matches(computed, declared)})
    out = out.withColumn("content_type_tika", types.magic(body)).withColumn("content_ffb", payload.first_four(body))
    if config.first_bytes:
        out = out.withColumn("content_first_bytes", payload.first_bytes(body, config.n_first_bytes))
    chosen = F.when(revisit, served).otherwise(types.choose(F.col("content_type_tika"), F.lit(None).cast("string"), F.try_element_at("warc_headers", F.lit("WARC-Identified-Payload-Type")), F.col("content_type_served"), F.lit(None).cast("string"), F.coalesce(length, F.lit(0)), revisit))
    out = out.withColumn("content_type_full", chosen)
    out = out.withColumns({"content_type": types.bare(F.col("content_type_full")), "content_type_norm": F.coalesce(types.kind(F.col("content_type_full")), F.lit("other")), "type": types.label(F.col("content_type_full"))})
    is_html = (F.col("content_type_norm") == "html") & ~revisit
    parse = html.normalised_features if config.normalise_links else html.features
    out = out.withColumn("_html", parse(F.when(is_html, F.make_valid_utf8(body.cast("string"))), F.col("url")))
    plain = F.when((F.col("content_type_norm") == "text") & ~revisit, text.trim_space(F.make_valid_utf8(body.cast("string"))))
    out = out.withColumns(
        {
            "title": adjust(F.col("_html.title"), config.rule("title")),
            "links": F.when(is_html, adjust_values(html.capped(F.col("_html.links")), config.rule("links"))),
            "links_images": F.when(is_html, html.capped(F.col("_html.images"))) if config.linked_resources else F.lit(None).cast("array<string>"),
            "generator": text.generators(_meta("generator"), _meta("software")),
            "last_modified": dates.crawl_date(dates.extract_date(dates.last_modified(*[_meta(n) for n in ("dcterms.created", "date", "last-modified")]))),
            "location": F.coalesce(_position("geo.position", ";"), _position("icbm", ","), text.location(text.degrees(_meta("geo:lat")), text.degrees(_meta("geo:long")))),
            "elements_used": F.col("_html.elements"),
            "license_url": F.col("_html.licenses"),
            "content": F.when(~types.has_script_type(F.col("content_type_full")), adjust(F.substring(F.coalesce(F.col("_html.text"), plain), 1, config.max_text), config.rule("content"))),
        }
    )
    if config.images:
        some = (F.col("content_type_norm") == "image") & ~revisit & records.image_gate(F.coalesce(length, F.lit(0)), config.max_image, F.col("id"), config.image_sampling)
        size = images.measured(F.when(some, body))
        out = out.withColumn("_image", size).withColumns({"image_height": F.col("_image.height"), "image_width": F.col("_image.width"), "image_size": F.col("_image.size")}).drop("_image")
    if config.xml_root:
        out = out.withColumn("xml_root_ns", types.root_namespace(F.when(types.bare(F.col("content_type_full")).rlike("xml$") & ~revisit, body)))
    out = out.withColumn("links_hosts", html.link_hosts(F.col("links")))
    return out.withColumns({"links_hosts_surts": html.link_surts(F.col("links_hosts")), "links_domains": html.link_domains(F.col("links_hosts")), "links_public_suffixes": html.link_suffixes(F.col("links_hosts"))})


def describe(docs: DataFrame, config: Config = DEFAULT, profiles: DataFrame | None = None) -> DataFrame:
    """Text fields of documents that have text; their language if there are profiles."""
    content = F.when(F.trim("content") != "", F.col("content"))
    cols = {"content_text_length": F.length(content)}
    if config.language and profiles is not None:
        cols["content_language"] = trigrams.nearest(content, profiles)["lang"]
    if config.postcodes:
        cols["postcode"] = text.postcodes(content)
        cols["postcode_district"] = F.array_distinct(F.transform(text.postcodes(content), text.district))
    if config.sentiment:
        cols["sentiment_score"] = text.sentiment(content)
    out = docs.withColumns(cols)
    if config.sentiment:
        out = out.withColumn("sentiment", text.mood(F.col("sentiment_score")))
    if config.fuzzy_hash:
        out = out.withColumn("ssdeep_hash", text.fuzzy(text.fuzzy_text(content)))
    return out if config.keep_text else out.drop("content")


def annotated(docs: DataFrame, tables: Tables) -> DataFrame:
    """docs with what the given tables say: collections and subjects, access terms, places, and domains by suffix rules.

    Each table meets the documents' keys, kept for all of them, and what it says joins the documents by id, once.
    """
    found: list[DataFrame] = []
    if tables == Tables(exclusions=tables.exclusions, profiles=tables.profiles):
        return docs
    keys = docs.select("id", "url", "host", "source_file", "_ts", "links_hosts", *(c for c in ("postcode_district",) if c in docs.columns)).dropDuplicates(["id"]).persist(StorageLevel.DISK_ONLY)
    if tables.annotations is not None:
        ranges = tables.ranges if tables.ranges is not None else docs.sparkSession.createDataFrame([], "collection string, start timestamp, end timestamp")
        found.append(annotate.annotate(keys.select("id", "url", "source_file", "_ts"), tables.annotations, ranges, time_col="_ts").select("id", "collection", "collections", "wct_subjects"))
    if tables.open_surts is not None:
        found.append(annotate.access_terms(keys.select("id", "url"), tables.open_surts).select("id", "access_terms"))
    if tables.districts is not None and "postcode_district" in docs.columns:
        found.append(annotate.located(keys.select("id", "postcode_district"), tables.districts).select("id", "locations"))
    if tables.suffixes is not None:
        each = keys.select("id", F.explode("links_hosts").alias("host"))
        known = suffixes(keys.select("host").union(each.select("host")), tables.suffixes).persist(StorageLevel.DISK_ONLY)
        found.append(keys.select("id", "host").join(known, "host").drop("host"))
        far = each.join(known, "host").groupBy("id")
        found.append(far.agg(F.array_sort(F.collect_set("domain")).alias("links_domains"), F.array_sort(F.collect_set("public_suffix")).alias("links_public_suffixes")))
        docs = docs.drop("domain", "public_suffix", "links_domains", "links_public_suffixes")
    for table in found:
        docs = docs.join(table, "id", "left")
    return docs


def documents(captures: DataFrame, config: Config = DEFAULT, slash_pages: bool = False, tables: Tables = Tables()) -> DataFrame:
    """Documents of the captures that pass the configured filters and aren't excluded."""
    out = identify(records.select(captures, config), config)
    out = out.where(F.col("url_type") == "slashpage") if slash_pages else out
    if tables.exclusions is not None:
        out = out.join(annotate.excluded(out, tables.exclusions), "id", "left_anti")
    out = describe(analyse(out, config), config, tables.profiles)
    for analyser in _ANALYSERS:
        out = analyser.apply(out, config)
    out = annotated(out.drop("payload", "_html", "warc_headers", "http_headers"), tables)
    return out.drop("_ts", "payload_digest")
