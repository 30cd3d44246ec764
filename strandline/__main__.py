"""Archives to documents from the command line: python -m strandline OUT ARCHIVE.."""

from __future__ import annotations

import argparse
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from strandline import config as settings
from strandline.plans.documents import Tables, documents
from strandline.ship import ship
from strandline.sources import captures, rules, sinks


def parser() -> argparse.ArgumentParser:
    out = argparse.ArgumentParser(prog="strandline", description="Documents of archived captures.")
    out.add_argument("out", nargs="?", help="where the documents go")
    out.add_argument("archives", nargs="*", help="archives, folders or patterns")
    out.add_argument("--config", help="settings as JSON or TOML")
    out.add_argument("--profile", choices=sorted(settings.PROFILES), default="default", help="settings without a file")
    out.add_argument("--print-config", action="store_true", help="print the settings and end")
    out.add_argument("--kind", choices=sorted(sinks.SINKS), default="jsonl", help="format of the documents")
    out.add_argument("--annotations", help="JSON of collections and date ranges")
    out.add_argument("--exclusions", help="url prefixes to leave out, one a line")
    out.add_argument("--open-surts", help="reversed-host prefixes of open access, one a line")
    out.add_argument("--suffixes", help="a public suffix list")
    out.add_argument("--districts", help="CSV of postcode district, latitude and longitude")
    out.add_argument("--language-profile", action="append", default=[], metavar="LANG=PATH", help="n-gram counts of a language")
    out.add_argument("--slash-pages", action="store_true", help="home pages alone")
    return out


def tables(spark: SparkSession, args: argparse.Namespace) -> Tables:
    given, ranges = rules.annotations(spark, args.annotations) if args.annotations else (None, None)
    profiles = dict(x.split("=", 1) for x in args.language_profile)
    of = lambda read, path: read(spark, path) if path else None
    return Tables(of(rules.prefixes, args.exclusions), given, ranges, of(rules.prefixes, args.open_surts), of(rules.profiles, profiles), of(rules.suffix_rules, args.suffixes), of(rules.districts, args.districts))


def main(argv: Sequence[str] | None = None, spark: SparkSession | None = None) -> DataFrame | None:
    args = parser().parse_args(argv)
    config = settings.read(args.config) if args.config else settings.PROFILES[args.profile]
    if args.print_config:
        print(*settings.lines(config), sep="\n")
        return None
    if not args.out or not args.archives:
        parser().error("give a place for the documents and at least one archive")
    spark = spark or SparkSession.builder.config("spark.sql.session.timeZone", "UTC").getOrCreate()
    ship(spark)
    docs = documents(captures.read(spark, args.archives, stage=config.hash_stage), config, args.slash_pages, tables(spark, args))
    sinks.write(docs, args.out, args.kind)
    return docs


if __name__ == "__main__":
    main()
