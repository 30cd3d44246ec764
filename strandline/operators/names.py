"""Rules over archive names: the first that matches the whole name sets fields from its templates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Rule = tuple[str, dict[str, str]]


def rule_number(name: Column, rules: Sequence[Rule]) -> Column:
    """Position of the first rule that matches; null if none does."""
    out = F.lit(None).cast("int")
    for i in reversed(range(len(rules))):
        out = F.when(name.rlike(f"^(?:{rules[i][0]})$"), i).otherwise(out)
    return out


def fields(name: Column, rules: Sequence[Rule]) -> dict[str, Column]:
    """A column for each field that any rule sets."""
    number, out = rule_number(name, rules), {}
    for f in dict.fromkeys(f for _, templates in rules for f in templates):
        value = F.lit(None).cast("string")
        for i, (pattern, templates) in enumerate(rules):
            if f in templates:
                value = F.when(number == i, F.regexp_replace(name, f"^(?:{pattern})$", templates[f])).otherwise(value)
        out[f] = value
    return out


def statistics(names: DataFrame, rules: Sequence[Rule], name_col: str = "name", order_col: str = "line") -> DataFrame:
    """Matches and last matching name of each rule; rule -1 counts the names without any."""
    numbered = names.select(F.coalesce(rule_number(F.col(name_col), rules), F.lit(-1)).alias("rule"), F.col(name_col).alias("name"), F.col(order_col).alias("at"))
    return numbered.groupBy("rule").agg(F.count("*").alias("matches"), F.max_by("name", "at").alias("last_name"))
