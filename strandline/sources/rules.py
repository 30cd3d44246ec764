"""Rule tables: annotations, prefix lists, look-up tables."""

from __future__ import annotations

import time
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

RULE = "struct<collection:string,collections:array<string>,subject:array<string>>"
ANNOTATIONS = f"collections map<string,map<string,{RULE}>>, collectionDateRanges map<string,struct<start:string,end:string>>"


def annotations(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Rules (scope, key, collection, collections, subject) and ranges (collection, start, end) of a JSON file."""
    whole = spark.read.schema(ANNOTATIONS).option("multiLine", True).json(path)
    scopes = whole.select(F.explode("collections").alias("scope", "rules"))
    rules = scopes.select("scope", F.explode("rules").alias("key", "r")).select("scope", "key", "r.*")
    at = lambda c: F.to_timestamp(F.col(f"r.{c}"), "yyyy-MM-dd'T'HH:mm:ss.SSSXX").alias(c)
    ranges = whole.select(F.explode("collectionDateRanges").alias("collection", "r")).select("collection", at("start"), at("end"))
    return rules, ranges


def write_annotations(rules: DataFrame, ranges: DataFrame, path: str) -> None:
    """The same file as one JSON document; rule tables are small by nature."""
    keyed = rules.groupBy("scope").agg(F.map_from_entries(F.collect_list(F.struct("key", F.struct("collection", "collections", "subject")))).alias("m"))
    one = keyed.agg(F.map_from_entries(F.collect_list(F.struct("scope", "m"))).alias("collections"))
    text = lambda c: F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss.SSSXX").alias(c)
    spans = ranges.agg(F.map_from_entries(F.collect_list(F.struct("collection", F.struct(text("start"), text("end"))))).alias("collectionDateRanges"))
    one.join(spans).coalesce(1).write.mode("overwrite").json(path)


def prefixes(spark: SparkSession, path: str) -> DataFrame:
    """(prefix) for each line that isn't empty or a comment."""
    return spark.read.text(path).select(F.trim("value").alias("prefix")).where("prefix != '' and not startswith(prefix, '#')").distinct()


class Reloaded:
    """A rule table that is read again when it is asked for after so many seconds, for the batches of a stream."""

    def __init__(self, read: Callable[[], DataFrame], seconds: float, clock: Callable[[], float] = time.monotonic):
        self.read, self.seconds, self.clock = read, seconds, clock
        self.at, self.table = None, None

    def get(self) -> DataFrame:
        now = self.clock()
        if self.at is None or now - self.at >= self.seconds:
            self.at, self.table = now, self.read()
        return self.table


def suffix_rules(spark: SparkSession, path: str) -> DataFrame:
    """(rule) of a public suffix list: a rule for each line up to its first blank, without ``//`` comments."""
    rule = F.lower(F.regexp_extract(F.trim("value"), r"^(\S+)", 1))
    return spark.read.text(path).select(rule.alias("rule")).where("rule != '' and not startswith(rule, '//')").distinct()


def profiles(spark: SparkSession, paths: dict[str, str]) -> DataFrame:
    """(lang, ngram, n) of files with lines of an n-gram and its count, one file for each language."""
    rows = [spark.read.schema("ngram string, n long").option("sep", "\t").option("quote", "").csv(path).select(F.lit(lang).alias("lang"), "ngram", "n") for lang, path in sorted(paths.items())]
    return reduce(DataFrame.union, rows).where("length(ngram) = 3 and n > 0")


def districts(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("district string, lat double, lon double").option("header", True).csv(path)


def colours(spark: SparkSession, path: str) -> DataFrame:
    """(ord, name, r, g, b) of lines name, hex, ``r,g,b``."""
    rows = spark.read.schema("name string, hex string, rgb string").option("sep", "\t").csv(path)
    part = lambda i: F.split_part("rgb", F.lit(","), F.lit(i)).cast("int")
    return rows.select(F.monotonically_increasing_id().alias("ord"), "name", part(1).alias("r"), part(2).alias("g"), part(3).alias("b"))
