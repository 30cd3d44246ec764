"""Index-like queries over document tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandline.functions import text as T


def predicate(query: str) -> Column:
    """``field:term``, ``field:prefix*``, ``field:"exact value"`` or ``*:*`` as a condition; terms are matched by token."""
    name, _, value = query.partition(":")
    if query == "*:*":
        return F.lit(True)
    if value.startswith('"') and value.endswith('"') and len(value) > 1:
        return F.col(name) == value[1:-1]
    if value.endswith("*"):
        return F.col(name).startswith(value[:-1])
    return F.array_contains(T.terms(F.col(name)), value.lower())


def search(docs: DataFrame, query: str) -> DataFrame:
    """Documents that all parts of a query joined by AND fit."""
    out = docs
    for part in query.split(" AND "):
        out = out.where(predicate(part.strip()))
    return out


def elevate(docs: DataFrame, pinned: list, excluded: list, id_col: str = "id") -> DataFrame:
    """Documents with ``place``: pinned ids first and in their order; excluded ones gone."""
    place = F.lit(len(pinned))
    for i, x in reversed(list(enumerate(pinned))):
        place = F.when(F.col(id_col) == x, i).otherwise(place)
    return docs.where(~F.col(id_col).isin(excluded)).withColumn("place", place)


def update(docs: DataFrame, changes: DataFrame, id_col: str = "id") -> DataFrame:
    """docs with the non-null values of changes put in by id; other columns and documents stay."""
    named = [c for c in changes.columns if c != id_col]
    out = docs.alias("d").join(changes.alias("c"), F.col(f"d.{id_col}") == F.col(f"c.{id_col}"), "left")
    return out.select(*[F.coalesce(f"c.{c}", f"d.{c}").alias(c) if c in named else F.col(f"d.{c}") for c in docs.columns])
