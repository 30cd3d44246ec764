"""Counts over documents: facets, timers, trigram profiles, nearest neighbours, duplicates."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strandline.functions import trigrams


def facet(docs: DataFrame, *names: str) -> DataFrame:
    """Rows for each combination of values; arrays count once for each of their values."""
    kinds = dict(docs.dtypes)
    for n in names:
        docs = docs.withColumn(n, F.explode(n)) if kinds[n].startswith("array") else docs
    return docs.groupBy(*names).agg(F.count("*").alias("n"))


def timers(events: DataFrame, parent: str, child: str, value: str, top: int, order: str = "total") -> DataFrame:
    """Count, total and mean for each (parent, child), the first ``top`` children of each parent by the chosen figure."""
    sums = events.groupBy(F.col(parent).alias("parent"), F.col(child).alias("child")).agg(F.count("*").alias("n"), F.sum(value).alias("total")).withColumn("mean", F.col("total") / F.col("n"))
    place = F.row_number().over(Window.partitionBy("parent").orderBy(F.desc(order), "child"))
    return sums.withColumn("place", place).where(F.col("place") <= top)


def slowest_types(docs: DataFrame, type_col: str, value: str, top: int = 20) -> DataFrame:
    bare = F.split_part(F.col(type_col), F.lit(";"), F.lit(1)).alias("type")
    return docs.groupBy(bare).agg(F.sum(value).alias("total"), F.count("*").alias("n")).orderBy(F.desc("total"), "type").limit(top)


def trigram_counts(docs: DataFrame, text_col: str, *by: str) -> DataFrame:
    """(by .., ngram, n) of lower-cased texts with everything but letters as underscore."""
    return trigrams.counts(docs, text_col, *by)


def nearest_profile(docs: DataFrame, profiles: DataFrame, id_col: str, text_col: str, farthest: float = 1.0) -> DataFrame:
    """(id, lang, distance): the language whose trigram frequencies are nearest, ``unknown`` beyond ``farthest``; texts without trigrams have no row.

    Profiles are a bounded table and are broadcast, so a text is scored where it is read.
    """
    got = docs.select(id_col, trigrams.nearest(F.col(text_col), profiles).alias("s")).where("s.lang is not null")
    return got.select(id_col, F.when(F.col("s.distance") < farthest, F.col("s.lang")).otherwise("unknown").alias("lang"), F.col("s.distance").alias("distance"))


def nearest_colour(pixels: DataFrame, colours: DataFrame) -> DataFrame:
    """pixels (.., r, g, b) with the name of the nearest colour by summed differences, the first of equals. colours is a fixed palette."""
    palette = colours.agg(F.array_sort(F.collect_list(F.struct("ord", "name", F.col("r").alias("cr"), F.col("g").alias("cg"), F.col("b").alias("cb")))).alias("palette"))
    away = lambda c: F.abs(F.col("r") - c["cr"]) + F.abs(F.col("g") - c["cg"]) + F.abs(F.col("b") - c["cb"])
    best = F.array_min(F.transform("palette", lambda c: F.struct(away(c).alias("d"), c["ord"].alias("ord"), c["name"].alias("name"))))
    return pixels.join(F.broadcast(palette)).withColumn("colour", best["name"]).drop("palette")  # one row


def duplicates(docs: DataFrame, digest: str, id_col: str, parts: int = 32) -> DataFrame:
    """(id, first): the smallest id with the same digest. Digests meet their minimum in ``parts`` pieces each, so a common one is spread."""
    part = F.pmod(F.xxhash64(id_col), F.lit(parts)).alias("part")
    rows = docs.select(id_col, digest, part)
    first = rows.groupBy(digest, "part").agg(F.min(id_col).alias("first")).groupBy(digest).agg(F.min("first").alias("first"), F.collect_set("part").alias("parts"))
    spread = first.select(digest, "first", F.explode("parts").alias("part"))
    return rows.join(spread, [digest, "part"]).select(id_col, "first")


def distinct_errors(docs: DataFrame, errors: str = "parse_error", kind: str | None = None) -> DataFrame:
    """(error, n) of the documents, of a general kind if one is named, that have parse errors."""
    rows = docs.where(F.col("content_type_norm") == kind) if kind else docs
    return rows.select(F.explode(errors).alias("error")).groupBy("error").agg(F.count("*").alias("n"))


def sampled_images(docs: DataFrame, kind: str = "content_type_norm", size: str = "image_size") -> DataFrame:
    """One row: images, and those of them that were measured."""
    image = F.col(kind) == "image"
    return docs.agg(F.count_if(image).alias("images"), F.count_if(image & F.col(size).isNotNull()).alias("measured"))


def host_edges(pages: DataFrame, host: str, hosts: str) -> DataFrame:
    return pages.select(F.col(host).alias("src"), F.explode(hosts).alias("dst"))
