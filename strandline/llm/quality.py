"""Quality rules combined by weak supervision.

Each rule votes good (1) or bad (-1) or abstains (0). Documents are counted by their pattern of votes; there are at
most 3 ** N_RULES patterns, so expectation-maximisation over the counts works on a table of fixed size. It
estimates the share of good documents and how often each rule votes wrongly on good and on bad ones, and the posterior probability of
good given a document's votes replaces the demand that every rule passes. A rule that alone is against a document the
others approve of is outvoted; rules that agree on bad documents gain weight.

What is presumed of the rules before any vote (``PRESUMED``) weighs as much as the share ``WEIGHT`` of each rule's votes,
whatever their number. It keeps the two kinds apart and no rule infallible: without it the likeliest good kind is that
of documents without any bad vote, which is the demand that every rule passes again.

All columns are native expressions; each statistic covers the whole text. A null text has no words and fails the
base test. Repeated rows have equal results. Ties between posterior and threshold keep the document. An empty table
gives an empty result. ``report`` ignores other columns; ``keep`` returns whole rows whatever their columns.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandline.llm._common import SPACE, cut, words, written

SYMBOLS = "#*$%&|<>"
#: Digits and punctuation of ASCII.
MARKS = "".join(c for c in map(chr, range(33, 127)) if not c.isalpha())
WINDOW = 5
THRESHOLD = 0.5


def _let(value: Column, body) -> Column:
    """body(value), with value computed once however often body or the optimizer repeats it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def repeat_words(hashes: Column, width: int = WINDOW) -> Column:
    """Words that lie in a window of ``width`` words which occurs twice or more, from the words' hashes."""
    starts = F.transform(hashes, lambda _, i: F.when(i + width <= F.size(hashes), F.xxhash64(*[F.get(hashes, i + k) for k in range(width)])))
    starts = F.slice(starts, F.lit(1), F.greatest(F.size(hashes) - (width - 1), F.lit(0)))

    def covered(keys: Column) -> Column:
        sort = F.array_sort(F.transform(keys, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        twice = lambda s: F.filter(s, lambda e, k: (F.get(s, k - 1)["h"] == e["h"]) | (F.get(s, k + 1)["h"] == e["h"]))
        places = F.array_sort(F.transform(_let(sort, twice), lambda e: e["i"]))
        count = lambda p: F.aggregate(F.transform(p, lambda x, k: F.least(F.lit(width), F.coalesce(F.get(p, k + 1) - x, F.lit(width)))), F.lit(0), lambda a, x: a + x)
        return _let(places, count)

    return _let(starts, lambda s: F.when(F.size(F.array_distinct(s)) < F.size(s), covered(s)).otherwise(F.lit(0)))


def figures(text: Column) -> Column:
    """Struct of the statistics of a text, as one expression."""
    text = F.coalesce(text, F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda s: F.length(F.btrim(s, F.lit(SPACE))) > 0)
    parts = F.struct(F.transform(words(text), lambda w: F.xxhash64(w)).alias("hashes"), lines.alias("lines"), F.translate(text, SPACE, "").alias("bare"))

    def count(p: Column) -> Column:
        whole = {
            "n_words": F.size(p["hashes"]),
            "word_chars": F.length(p["bare"]),
            "n_symbols": F.length(p["bare"]) - F.length(F.translate(p["bare"], SYMBOLS, "")),
            "n_dup_lines": F.size(p["lines"]) - F.size(F.array_distinct(p["lines"])),
            "n_repeat_words": repeat_words(p["hashes"]),
            "n_lines": F.size(p["lines"]),
            "n_distinct": F.size(F.array_distinct(p["hashes"])),
            "n_loud": F.length(p["bare"]) - F.length(F.translate(p["bare"], "ABCDEFGHIJKLMNOPQRSTUVWXYZ!", "")),
            "n_marks": F.length(p["bare"]) - F.length(F.translate(p["bare"], MARKS, "")),
            "n_symbol_runs": F.regexp_count(p["bare"], F.lit(f"[{SYMBOLS}]+")),
        }
        return F.struct(*[c.cast("long").alias(n) for n, c in whole.items()])

    return _let(parts, count)


def _vote(good: Column, bad: Column) -> Column:
    return F.when(bad, -1).when(good, 1).otherwise(0)


def rules(f: Column) -> dict[str, Column]:
    """Name and vote of each rule, from the statistics."""
    ratio = lambda a, b: f[a] / F.greatest(f[b], F.lit(1))
    n = f["n_words"]
    length, symbols, dup = ratio("word_chars", "n_words"), ratio("n_symbols", "word_chars"), ratio("n_dup_lines", "n_lines")
    repeat, variety, loud = ratio("n_repeat_words", "n_words"), ratio("n_distinct", "n_words"), ratio("n_loud", "word_chars")
    runs, marks = ratio("n_symbol_runs", "n_words"), ratio("n_marks", "word_chars")
    enough = n >= 20
    return {
        "length": _vote(n >= 30, n < 10),
        "word_length": _vote(enough & length.between(3.0, 10.0), (length < 2.0) | (length > 15.0)),
        "symbols": _vote(enough & (symbols < 0.01), symbols > 0.05),
        "duplicate_lines": _vote((f["n_lines"] >= 4) & (dup < 0.1), dup > 0.3),
        "repeated_words": _vote(enough & (repeat < 0.05), repeat > 0.2),
        "variety": _vote((n >= 50) & (variety > 0.25), (n >= 50) & (variety < 0.15)),
        "loudness": _vote(enough & (loud < 0.1), loud > 0.4),
        "symbol_runs": _vote(enough & (runs < 0.02), runs > 0.1),
        "marks": _vote(enough & (marks < 0.06), enough & (marks > 0.09)),
    }


def pattern(f: Column) -> Column:
    """The votes as one number, a digit of base 3 for each rule."""
    out = F.lit(0)
    for j, v in enumerate(rules(f).values()):
        out = out + (v + 1) * 3**j
    return out.cast("int")


def _vote_of(code: Column, j: int) -> Column:
    return F.pmod(F.floor(code / 3**j), F.lit(3)).cast("int") - 1


#: As many as ``rules`` has.
N_RULES = 9
#: The chance of a bad vote, by a rule that votes, on good (1) and on bad documents (0), as it is presumed.
PRESUMED = {1: 0.05, 0: 0.3}
#: The share of a rule's votes that the presumption weighs as much as.
WEIGHT = 0.5
#: The model that the rounds begin with.
START = {1: 0.02, 0: 0.5}
#: The share of good documents (first) and each rule's chance of a bad vote, if it votes, on good (1) and on bad documents (0).
Model = tuple[float, dict[int, list[float]]]


def _posterior(code: Column, model: Model) -> Column:
    """Probability of good given the votes, by their log odds; who abstains says nothing."""
    prior, bad = model
    odds = F.lit(math.log(prior / (1 - prior)))
    for j in range(N_RULES):
        v, g, b = _vote_of(code, j), bad[1][j], bad[0][j]
        odds = odds + F.when(v == -1, math.log(g / b)).when(v == 1, math.log((1 - g) / (1 - b))).otherwise(0.0)
    return 1 / (1 + F.exp(-odds))


def fit(codes: DataFrame, rounds: int = 100) -> Model:
    """The model of (code) by expectation-maximisation over the counted patterns; a row of sums comes back each round."""
    counts = cut(codes.groupBy("code").agg(F.count("*").alias("n")).coalesce(1))
    model: Model = (0.9, {y: [START[y]] * N_RULES for y in (0, 1)})
    for _ in range(rounds):
        n, p = F.col("n"), F.col("p")
        sums = [F.sum(F.when(_vote_of(F.col("code"), j) == v, w).otherwise(0.0)).alias(f"y{y}_{j}_{v}") for y, w in ((1, n * p), (0, n * (1 - p))) for j in range(N_RULES) for v in (-1, 1)]
        got = counts.withColumn("p", _posterior(F.col("code"), model)).agg(F.sum(n * p).alias("good"), F.sum(n).alias("all"), *sums).first()
        if not got["all"]:
            break
        new = step(got["good"], got["all"], {y: [(got[f"y{y}_{j}_-1"], got[f"y{y}_{j}_1"]) for j in range(N_RULES)] for y in (0, 1)})
        moved = max(abs(a - b) for y in (0, 1) for a, b in zip(new[1][y], model[1][y], strict=True))
        model = new
        if moved < 1e-4:
            break
    return model


def step(good: float, every: float, votes: dict[int, list[tuple[float, float]]]) -> Model:
    """The next model, from the expected numbers of good documents and of each rule's bad and good votes by kind."""
    rate = lambda y, bad, ok: (bad + PRESUMED[y] * (WEIGHT * (bad + ok) + 1)) / ((1 + WEIGHT) * (bad + ok) + 1)
    return (good + 9) / (every + 10), {y: [rate(y, *v) for v in own] for y, own in votes.items()}


def base_failed(f: Column) -> Column:
    return (f["n_words"] < 10) | (100 * f["n_repeat_words"] > 20 * f["n_words"])


def verdict(f: Column, model: Model, threshold: float = THRESHOLD) -> Column:
    """Struct (base_failed, probability, kept)."""
    inner = lambda p: F.struct(base_failed(f).alias("base_failed"), p.alias("probability"), (~base_failed(f) & (p >= threshold)).alias("kept"))
    return _let(_let(pattern(f), lambda code: _posterior(code, model)), inner)


def keep(docs: DataFrame, text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows of docs that are kept. Texts are measured once; rows wait for the fit in the shared folder, with their votes."""
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    voted = lambda f: F.struct(pattern(f).alias("code"), base_failed(f).alias("failed"))
    rows = written(docs.select(row, _let(figures(F.col(f"`{text_col}`")), voted).alias("v")), "quality")
    model = fit(rows.select("v.code"))
    return rows.where(~F.col("v.failed") & (_posterior(F.col("v.code"), model) >= threshold)).select("row.*")


def report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """A row per document: id, the statistics, base_failed, probability and kept. Texts are read once; the figures are stored for the second pass."""
    measured = cut(docs.select(F.col(f"`{id_col}`").alias("id"), figures(F.col(f"`{text_col}`")).alias("f")))
    model = fit(measured.select(_let(F.col("f"), pattern).alias("code")))
    return measured.select("id", "f", verdict(F.col("f"), model, threshold).alias("v")).select(F.col("id").alias(id_col), "f.*", "v.*")
