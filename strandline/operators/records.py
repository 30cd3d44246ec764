"""Row filters over capture records, in the order in which they are applied."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandline.config import Config


def _any(tests: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, tests, F.lit(False))


def of_type(record_type: Column, allowed: tuple[str, ...]) -> Column:
    """An empty list passes all; records of the older format always pass."""
    return record_type.isin("arc", *allowed) if allowed else F.lit(True)


def with_protocol(url: Column, protocols: tuple[str, ...]) -> Column:
    """An empty list passes nothing."""
    return _any([url.startswith(p) for p in protocols])


def excluded_url(url: Column, patterns: tuple[str, ...]) -> Column:
    return _any([url.rlike(p) for p in patterns if p])


def with_status(url: Column, status: Column, prefixes: tuple[str, ...]) -> Column:
    """Only http(s) urls are tested; a null status fails unless the list is empty."""
    if not prefixes:
        return F.lit(True)
    return ~url.startswith("http") | F.coalesce(_any([status.startswith(p) for p in prefixes]), F.lit(False))


def select(records: DataFrame, config: Config) -> DataFrame:
    """records (record_type, url, http_status ..) that pass type, url, protocol, exclusion and status tests."""
    url = F.substring("url", 1, config.rule("url").max_length) if config.rule("url").max_length > 0 else F.col("url")
    out = records.where(of_type(F.col("record_type"), config.record_types)).where(F.col("url").isNotNull()).withColumn("url", url)
    out = out.where(with_protocol(F.col("url"), config.protocols))
    out = out.where(~excluded_url(F.col("url"), config.url_excludes)) if config.url_excludes else out
    status = F.when(F.col("record_type") == "resource", F.lit("200")).otherwise(F.col("http_status"))
    return out.where(with_status(F.col("url"), status, config.response_codes))


def sampled(key: Column, rate: int) -> Column:
    """One of ``rate`` rows, always the same ones."""
    return F.pmod(F.xxhash64(key), F.lit(rate)) == 0


def image_gate(length: Column, most: int, key: Column, rate: int) -> Column:
    return (length <= most) & sampled(key, rate)
