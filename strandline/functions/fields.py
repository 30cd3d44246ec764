"""Clean-up of output fields, built from rules as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from strandline.config import FieldRule


def control_to_space(c: Column) -> Column:
    return F.regexp_replace(c, r"\p{Cntrl}", " ")


def squeeze(c: Column) -> Column:
    return F.regexp_replace(F.btrim(c, F.lit(" \t\n\x0b\x0c\r")), r"\p{Space}+", " ")


def rewrite(c: Column, rules: tuple[tuple[str, str], ...]) -> Column:
    for pattern, replacement in rules:
        c = F.regexp_replace(c, pattern, replacement)
    return c


def adjust(c: Column, rule: FieldRule = FieldRule()) -> Column:
    """Control characters, UTF-8 repair, white space, rewrites and cut, in this order; empty becomes null."""
    if 0 in (rule.max_length, rule.max_values):
        return F.lit(None).cast("string")
    c = control_to_space(c) if rule.control_to_space else c
    c = F.make_valid_utf8(c) if rule.repair_utf8 else c
    c = squeeze(c) if rule.squeeze else c
    c = rewrite(c, rule.rewrites)
    c = F.substring(c, 1, rule.max_length) if rule.max_length > 0 else c
    return F.nullif(c, F.lit(""))


def adjust_values(c: Column, rule: FieldRule = FieldRule()) -> Column:
    """``adjust`` for each of several values; a bound on their number also removes repeats."""
    if rule.max_values == 0:
        return F.array().cast("array<string>")
    c = F.filter(F.transform(c, lambda x: adjust(x, rule)), lambda x: x.isNotNull())
    return F.slice(F.array_distinct(c), 1, rule.max_values) if rule.max_values > 0 else c


def merge(old: Column, new: Column) -> Column:
    return F.array_union(F.coalesce(old, F.array().cast("array<string>")), F.coalesce(new, F.array().cast("array<string>")))
