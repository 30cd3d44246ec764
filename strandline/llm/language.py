"""Languages of a document as a mixture, by expectation-maximisation over hashed byte trigrams.

Training sums the trigrams of the labelled texts by language. A document is a mixture of languages: EM finds the
shares that maximise the likelihood of its trigrams for one, two, three .. languages until a further one no longer gains
``PENALTY`` times the logarithm of the number of trigrams. The language with the largest share is the prediction and
its share the score. Cells are counted by sorting, so a task's memory follows the bytes it looks at and the languages,
not the number of texts.

A null text, or one without a letter, is ``und`` with score 0. A text too short for a trigram is looked at with a space on
either side. Rows without a language don't train. If nothing trains, all is ``und``. Ties go to the first language
by code point. Repeated rows have equal results. Whole texts count; the model, which is broadcast, has ``BUCKETS``
numbers for each language and is refused beyond ``max_languages``, a bound on what is broadcast. ``predict`` keeps
the columns of docs whatever their names, but for those named as its own four.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandline.llm._tokens import pieces

BUCKETS = 1 << 14
MAX_LANGUAGES = 512
#: Trigrams times languages that are looked at together, unless one text is longer.
TOGETHER = 1 << 20
PENALTY = 12.0
ROUNDS = 8
UNKNOWN = "und"

_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
_FOLD[[*range(0, 65), *range(91, 97), *range(123, 128)]] = 32


def fold(data: np.ndarray) -> np.ndarray:
    """Lower-cased bytes with all ASCII that isn't a letter as space; Latin-1 capitals of two bytes are lower-cased too."""
    out = _FOLD[data]
    if len(data) > 1:
        capital = (data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E) & (data[1:] != 0x97)
        out[1:][capital] += 0x20
    return out


def trigrams(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Text number and bucket of each trigram that isn't all spaces."""
    b = fold(data).astype(np.uint32)
    if len(b) < 3:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    key = (b[:-2] << np.uint32(16)) | (b[1:-1] << np.uint32(8)) | b[2:]
    text = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    keep = (text[:-2] == text[2:]) & (key != 0x202020)
    bucket = ((key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - 14)).astype(np.int64)
    return text[:-2][keep], bucket[keep]


def count(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """(lang, bucket, n) over all rows with a language: summed in each task, then by key."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            names = batch.column(1).to_pylist()
            for first, _, data, offsets in pieces(batch.column(0)):
                text, bucket = trigrams(data, offsets)
                langs = names[first : first + len(offsets) - 1]
                for name in set(langs):
                    own = np.array([x == name for x in langs])
                    sums[name] = sums.get(name, 0) + np.bincount(bucket[own[text]], minlength=BUCKETS)
        for name, n in sums.items():
            (full,) = np.nonzero(n)
            yield pa.RecordBatch.from_arrays([pa.array([name] * len(full), pa.string()), pa.array(full, pa.int32()), pa.array(n[full], pa.int64())], names=["lang", "bucket", "n"])

    rows = docs.where(F.col(f"`{lang_col}`").isNotNull()).select(F.col(f"`{text_col}`").alias("text"), F.col(f"`{lang_col}`").alias("lang"))
    return rows.mapInArrow(run, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))


class Model:
    def __init__(self, langs: list[str], counts: np.ndarray):
        self.langs = langs
        self.p = ((counts + 0.5) / (counts.sum(1, keepdims=True) + 0.5 * BUCKETS)).T.astype(np.float64).copy()  # bucket x language

    def _likelihood(self, p: np.ndarray, x: np.ndarray, start: np.ndarray, doc: np.ndarray, langs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """EM over the given languages of each text (texts x k): log-likelihood and shares."""
        k = langs.shape[1]
        every = k == p.shape[1] and (langs == np.arange(k)).all()
        own = p if every else np.take_along_axis(p, langs[doc], 1)
        share = np.full(langs.shape, 1.0 / k)
        total = np.add.reduceat(x, start)
        for _ in range(ROUNDS):
            part = own * share[doc]
            part *= (x / part.sum(1))[:, None]
            share = np.add.reduceat(part, start, axis=0) / total[:, None]
        return np.add.reduceat(x * np.log((own * share[doc]).sum(1) + 1e-300), start), share

    def mixture(self, data: np.ndarray, offsets: np.ndarray) -> list[list[tuple[str, float]]]:
        """Languages and shares of each text, the largest first; nothing for a text without trigrams."""
        n_docs = len(offsets) - 1
        out: list[list[tuple[str, float]]] = [[] for _ in range(n_docs)]
        text, bucket = trigrams(data, offsets)
        if not len(text) or not self.langs:
            return out
        cells = text * BUCKETS + bucket
        cells.sort()
        begin = np.flatnonzero(np.r_[True, cells[1:] != cells[:-1]])
        full, x = cells[begin], np.diff(np.r_[begin, len(cells)]).astype(np.float64)
        ids, start, doc = np.unique(full // BUCKETS, return_index=True, return_inverse=True)
        p = self.p[full % BUCKETS]
        logs = np.log(p)
        alone = np.add.reduceat(x[:, None] * logs, start, axis=0)
        total = np.add.reduceat(x, start)
        first = np.argmax(alone, 1)
        best = alone[np.arange(len(ids)), first]
        langs, shares = [[int(i)] for i in first], [[1.0]] * len(ids)
        todo = np.arange(len(ids))
        if len(self.langs) > 1:
            _, every = self._likelihood(p, x, start, doc, np.tile(np.arange(len(self.langs)), (len(ids), 1)))
            every[np.arange(len(ids)), first] = 2.0
            order = np.argsort(-every, 1, kind="stable")
            for k in range(2, len(self.langs) + 1):
                rows = np.flatnonzero(np.isin(doc, todo))
                if not len(rows):
                    break
                begin = np.flatnonzero(np.r_[True, doc[rows][1:] != doc[rows][:-1]])
                number = np.cumsum(np.r_[False, doc[rows][1:] != doc[rows][:-1]])
                score, share = self._likelihood(p[rows], x[rows], begin, number, order[todo, :k])
                score -= (k - 1) * PENALTY * np.log(total[todo] + 1)
                won = score > best[todo]
                for i, s in zip(todo[won], share[won], strict=True):
                    langs[i], shares[i] = order[i, :k].tolist(), s.tolist()
                best[todo[won]] = score[won]
                todo = todo[won]
        for i, own, part in zip(ids.tolist(), langs, shares, strict=True):
            out[i] = sorted(((self.langs[j], s) for j, s in zip(own, part, strict=True)), key=lambda t: (-t[1], t[0]))
        return out


def fit(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", max_languages: int = MAX_LANGUAGES) -> Model:
    """The model of all labelled rows of docs. What comes to the driver is BUCKETS numbers for each language at most."""
    summed = count(docs, text_col, lang_col).groupBy("lang").agg(F.collect_list(F.struct("bucket", "n")).alias("cells"))
    rows = summed.orderBy("lang").take(max_languages + 1)
    if len(rows) > max_languages:
        raise ValueError(f"more than {max_languages} languages; max_languages bounds the model that is broadcast")
    rows.sort(key=lambda r: r["lang"])
    counts = np.zeros((len(rows), BUCKETS))
    for i, r in enumerate(rows):
        cells = np.array([(c["bucket"], c["n"]) for c in r["cells"]], np.int64)
        counts[i, cells[:, 0]] = cells[:, 1]
    return Model([r["lang"] for r in rows], counts)


def has_letter(text: Column) -> Column:
    return F.coalesce(text.rlike(r"\p{L}"), F.lit(False))


def predict(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """docs with _langs (the set, largest share first), _shares, lang_pred and score appended as _lang_pred and _score."""
    shared = docs.sparkSession.sparkContext.broadcast((model.langs, model.p))

    @F.pandas_udf("langs array<string>, shares array<double>")
    def infer(text):
        import pandas as pd

        own = object.__new__(Model)
        own.langs, own.p = shared.value
        found: list[list[tuple[str, float]]] = []
        for _, _, data, offsets in pieces(pa.array(text, pa.string(), from_pandas=True), max(1 << 12, TOGETHER // max(8, len(own.langs)))):
            found += own.mixture(data, offsets)
        if short := [i for i, (f, t) in enumerate(zip(found, text, strict=True)) if not f and t]:
            for _, _, data, offsets in pieces(pa.array([f" {text.iloc[i]} " for i in short], pa.string())):
                for f in own.mixture(data, offsets):
                    found[short.pop(0)] = f
        return pd.DataFrame({"langs": [[name for name, _ in f] for f in found], "shares": [[s for _, s in f] for f in found]})

    text = F.col(f"`{text_col}`")
    own = [F.col(f"`{c}`") for c in docs.columns if c not in ("_langs", "_shares", "_lang_pred", "_score")]
    got = docs.select(F.struct(*own).alias("row"), infer(text).alias("found"), has_letter(text).alias("letter"))
    known = F.col("letter") & (F.size("found.langs") > 0)
    top, share = F.get("found.langs", F.lit(0)), F.get("found.shares", F.lit(0))
    return got.select(
        "row.*",
        F.col("found.langs").alias("_langs"),
        F.col("found.shares").alias("_shares"),
        F.when(known, top).otherwise(UNKNOWN).alias("_lang_pred"),
        F.when(known, F.least(share, F.lit(1.0))).otherwise(0.0).alias("_score"),
    )
