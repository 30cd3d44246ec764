"""Trigrams of letters by the batch: windows of three code points as one number each, counted where the texts are read."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructType

from strandline.functions import batches

#: Characters that are looked at together, unless one text is longer.
TOGETHER = 1 << 19
#: Distinct counts that a task holds before it sends them on.
HELD = 500_000
#: Counts that go out in one batch.
SENT = 50_000


def folded(text: Column) -> Column:
    """What trigrams are taken from: lower case, with everything but letters as underscore."""
    return F.regexp_replace(F.lower(text), r"[^\p{L}]", "_")


def windows(texts: list[str | None]) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first, end, text number from first, trigram) for runs of texts."""
    first, size = 0, 0
    for i, t in enumerate([*texts, None]):
        if i == len(texts) or (i > first and size + len(t or "") > TOGETHER):
            own = [t or "" for t in texts[first:i]]
            points = np.frombuffer("".join(own).encode("utf-32-le"), np.uint32).astype(np.int64)
            number = np.repeat(np.arange(len(own)), [len(t) for t in own])
            same = number[:-2] == number[2:]
            yield first, i, number[:-2][same], ((points[:-2] << 42) | (points[1:-1] << 21) | points[2:])[same]
            first, size = i, 0
        size += len(t or "")


def name(trigrams: np.ndarray) -> list[str]:
    points = np.stack([trigrams >> 42, (trigrams >> 21) & 0x1FFFFF, trigrams & 0x1FFFFF], 1).astype(np.uint32)
    whole = points.tobytes().decode("utf-32-le")
    return [whole[i : i + 3] for i in range(0, len(whole), 3)]


def number(names: list[str]) -> np.ndarray:
    points = np.frombuffer("".join(names).encode("utf-32-le"), np.uint32).astype(np.int64).reshape(-1, 3)
    return (points[:, 0] << 42) | (points[:, 1] << 21) | points[:, 2]


def counts(docs: DataFrame, text_col: str, *by: str) -> DataFrame:
    """(by .., ngram, n): summed in each task, then by key."""

    def run(given: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple, list] = {}
        size = 0

        def flush() -> Iterator[pa.RecordBatch]:
            for key, parts in held.items():
                trigram, n = merged(parts)
                for i in range(0, len(n), SENT):
                    some = n[i : i + SENT]
                    columns = [pa.repeat(pa.scalar(v, kind), len(some)) for v, kind in zip(key, kinds, strict=True)]
                    yield pa.RecordBatch.from_arrays([*columns, pa.array(name(trigram[i : i + SENT]), pa.string()), pa.array(some)], names=[*by, "ngram", "n"])
            held.clear()

        for batch in given:
            kinds = [batch.schema.field(c).type for c in by]
            every = list(zip(*[batch.column(c).to_pylist() for c in by], strict=True)) if by else [()] * batch.num_rows
            texts = batch.column("text")
            for keys, first, end, text, trigram in ((every[a:b], *w) for a, b in batches.runs(texts) for w in windows(texts[a:b].to_pylist())):
                groups = {k: i for i, k in enumerate(dict.fromkeys(keys[first:end]))}
                group = np.array([groups[k] for k in keys[first:end]])[text]
                for k, i in groups.items():
                    found = np.unique(trigram[group == i], return_counts=True) if len(groups) > 1 else np.unique(trigram, return_counts=True)
                    if len(found[0]):
                        held.setdefault(k, []).append(found)
                        size += len(found[0])
                if size > HELD:
                    yield from flush()
                    size = 0
        if held:
            yield from flush()

    kinds = dict(docs.dtypes)
    rows = docs.select(*by, folded(F.col(text_col)).alias("text"))
    schema = ", ".join([*(f"`{c}` {kinds[c]}" for c in by), "ngram string, n long"])
    return rows.mapInArrow(run, schema).groupBy(*by, "ngram").agg(F.sum("n").alias("n"))


def merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    trigram, n = (np.concatenate(x) for x in zip(*parts, strict=True))
    order = np.argsort(trigram, kind="stable")
    trigram, n = trigram[order], n[order]
    start = np.flatnonzero(np.r_[True, trigram[1:] != trigram[:-1]])
    return trigram[start], np.add.reduceat(n, start)


class Profiles:
    """Trigram frequencies of languages, side by side, and the languages in order."""

    def __init__(self, rows: list[tuple[str, str, int]]):
        self.langs = sorted({lang for lang, _, _ in rows})
        every = number([g for _, g, _ in rows])
        self.keys, place = np.unique(every, return_inverse=True)
        self.f = np.zeros((len(self.keys), len(self.langs)))
        at = {lang: i for i, lang in enumerate(self.langs)}
        np.add.at(self.f, (place, [at[lang] for lang, _, _ in rows]), [n for _, _, n in rows])
        self.f /= np.maximum(self.f.sum(0), 1)

    def distances(self, texts: list[str | None]) -> np.ndarray:
        """Texts by languages; infinite for a text without a trigram."""
        out = np.full((len(texts), len(self.langs)), np.inf)
        theirs = (self.f**2).sum(0)
        for first, _, text, trigram in windows(texts):
            if not len(text):
                continue
            own, place = np.unique(trigram, return_inverse=True)
            at = np.minimum(np.searchsorted(self.keys, own), len(self.keys) - 1)
            theirs_of = np.where((self.keys[at] == own)[:, None], self.f[at], 0.0)
            cell = text * len(own) + place
            cell.sort()
            start = np.flatnonzero(np.r_[True, cell[1:] != cell[:-1]])
            n, text, place = np.diff(np.r_[start, len(cell)]), cell[start] // len(own), cell[start] % len(own)
            begin = np.flatnonzero(np.r_[True, text[1:] != text[:-1]])
            f = n / np.repeat(np.add.reduceat(n, begin), np.diff(np.r_[begin, len(n)]))
            squares = np.add.reduceat(f * f, begin)[:, None] + theirs[None, :] - 2 * np.add.reduceat(theirs_of[place] * f[:, None], begin, axis=0)
            out[first + text[begin]] = np.sqrt(np.maximum(squares, 0))
        return out


def scored(texts: pa.Array, own: Profiles | None) -> pa.Array:
    """(lang, distance) of each text; a run of texts at a time are Python objects."""
    least, lang = np.full(len(texts), np.inf), [None] * len(texts)
    for first, end in batches.runs(texts) if own is not None else ():
        d = own.distances(texts[first:end].to_pylist())
        least[first:end] = d.min(1)
        lang[first:end] = [own.langs[i] if np.isfinite(m) else None for i, m in zip(d.argmin(1), d.min(1), strict=True)]
    return pa.StructArray.from_arrays([pa.array(lang, pa.string()), pa.array(least, pa.float64(), mask=~np.isfinite(least))], ["lang", "distance"])


def nearest(text: Column, profiles: DataFrame, most: int = 2_000_000) -> Column:
    """Struct (lang, distance) of the profile (lang, ngram, n) whose frequencies are nearest; null for a text without a trigram.

    Profiles are broadcast; ``most`` bounds their rows.
    """
    rows = profiles.select("lang", "ngram", "n").where("lang is not null").take(most + 1)
    if len(rows) > most:
        raise ValueError(f"the profiles have more than {most} rows")
    shared = profiles.sparkSession.sparkContext.broadcast(Profiles([tuple(r) for r in rows]) if rows else None)

    @F.arrow_udf(StructType().add("lang", StringType()).add("distance", DoubleType()))
    def found(texts: pa.Array) -> pa.Array:
        return scored(texts, shared.value)

    return found.asNondeterministic()(folded(text))  # else a filter on the result would have it computed twice
