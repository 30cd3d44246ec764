"""Language-model scores from a log-frequency Bloom filter.

Counts of words and word pairs are summed in each task, sent to a shard by hash, summed there, and put into the
shard's filter: an n-gram with count c is inserted as (n-gram, 1) .. (n-gram, q) with q = 1 + floor(log_b c). A count is read
back by probing (n-gram, 1), (n-gram, 2) .. until a probe fails, so errors only ever raise it and become rarer with each step.
Of the pairs neither counts nor keys are kept, only the bits; they are broadcast. A task remembers the words that it has
looked up.

P(w | v) = m * low(v w) / high(v) + (1 - m) * P(w), P(w) = (low(w) + 1) / (N + V + 1), where low and high are the least and the
greatest count of the level that was read. So the probabilities of all words and one unknown word add up to 1 at most, and
to no less than one part in the two bases' product, but for pairs that the filter shows by mistake (one in about 45).
The weight m is one for each band of c(v), C / (C + T) with the band's tokens C and its distinct pairs T (Witten and
Bell), summed over the distinct pairs of all shards. The text's score is the sum of log10 P over its words and the end mark;
the first word follows a start mark.

The filters and the exact word counts behind the base score are broadcast while each takes ``MAX_FILTER`` bytes at most.
Beyond, the probes travel instead of the filters: texts are dealt to groups by a hash, a group sends its distinct words and pairs
to the units of shards that hold their filters, these look up each key once for all groups and answer with levels, and the answers
meet the texts, which are read again. Scores are the same either way. Rows with the same id and text are in one group.

A null text is empty and has the end mark alone. Repeated rows have equal scores. Without training rows every count is
0. An empty table gives an empty result. Other columns are ignored. Words are told apart by 64 bits of hash, pairs by 32
and 32 of their first word.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import cache, reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandline.llm._common import cut
from strandline.llm._tokens import mix, pieces, release, word_hashes

BASES = {1: 1.1, 2: 1.25}
BITS, HASHES = 8, 5
#: Most bits of a shard's number.
SHARD_BITS = 20
MAX_FILTER = 192 << 20
#: Bytes of a group of texts whose probes travel together, and of those that one unit of shards looks up.
GROUP, UNIT = 6 << 20, 16 << 20
#: Groups ask in so many rounds at most, of so many bytes of text at least: the probes of a round wait on disk.
ROUNDS, ROUND = 4, 256 << 20
#: Rows of n-grams that a task sums before it sends them on.
HELD = 2_000_000
#: A task remembers words that occur this often, up to so many before it begins anew; the others are looked up each time.
OFTEN, REMEMBERED = 16, 1_000_000
BANDS, BAND = 16, 16
START, END = np.uint64(0x5D1A3B7C9E2F4681), np.uint64(0xE4D9B8A7C6F50312)
LOW = np.uint64(0xFFFFFFFF)


def tokens(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Tokens (each text's words and the end), the token before each, and where each text's tokens begin."""
    words, at = word_hashes(data, offsets)
    return np.insert(words, at[1:], END), np.insert(words, at[:-1], START), at + np.arange(len(at))


def pair_keys(before: np.ndarray, token: np.ndarray) -> np.ndarray:
    """64 bits: 32 of the pair, which choose the shard, then 32 of the word before."""
    return (mix(before * np.uint64(0xC2B2AE3D27D4EB4F) + token) & ~LOW) | (before >> np.uint64(32))


def _sum(keys: np.ndarray, counts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order, and their summed counts."""
    if not len(keys):
        return keys, np.zeros(0, np.int64)
    if counts is None:
        keys = np.sort(keys)
    else:
        order = np.argsort(keys, kind="stable")
        keys, counts = keys[order], counts[order]
    start = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
    return keys[start], np.diff(np.r_[start, len(keys)]) if counts is None else np.add.reduceat(counts, start)


def _blobs(order: int, bits: int, keys: np.ndarray, counts: np.ndarray) -> Iterator[tuple]:
    """A row for each shard."""
    shard = (keys >> np.uint64(64 - bits)).astype(np.int64)
    ends = np.searchsorted(shard, np.arange((1 << bits) + 1))
    for s, (a, b) in enumerate(zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)):
        if b > a:
            yield order, s, keys[a:b].tobytes(), np.minimum(counts[a:b], 0xFFFFFFFF).astype(np.uint32).tobytes()


def _rows(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)


BLOB = pa.schema([("ord", pa.int32()), ("shard", pa.int32()), ("keys", pa.binary()), ("counts", pa.binary())])


def _count(bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[np.ndarray]] = {1: [], 2: []}
        size = {1: 0, 2: 0}

        def flush(order: int) -> Iterator[pa.RecordBatch]:
            keys, counts = _sum(np.concatenate(held[order]))
            held[order], size[order] = [], 0
            rows = list(_blobs(order, bits, keys, counts))
            for a in range(0, len(rows), 64):
                yield _rows(rows[a : a + 64], BLOB)

        for batch in batches:
            for _, _, data, offsets in pieces(batch.column(0)):
                token, before, _ = tokens(data, offsets)
                for order, keys in ((1, token), (2, pair_keys(before, token))):
                    held[order].append(keys)
                    size[order] += len(keys)
                    if size[order] > HELD:
                        yield from flush(order)
        for order in (1, 2):
            if size[order]:
                yield from flush(order)

    return run


def levels(counts: np.ndarray, base: float) -> np.ndarray:
    return 1 + np.floor(np.log(counts) / math.log(base) + 1e-9).astype(np.int64)


@cache
def bounds(base: float, most: int = 256) -> tuple[np.ndarray, np.ndarray]:
    """The least and the greatest count of each level; 0 for level 0."""
    low, high = np.zeros(most), np.zeros(most)
    for q in range(1, most):
        low[q] = math.ceil(base ** (q - 1) - 1e-9)
        high[q] = max(low[q], math.ceil(base**q - 1e-9) - 1)
    return low, high


def _grown(keys: np.ndarray, level: int) -> np.ndarray:
    return mix(keys + np.uint64((level * 0x9E3779B97F4A7C15) % (1 << 64)))


def _place(g: np.ndarray, n_bits: np.ndarray, i: int) -> np.ndarray:
    if i:
        g = g + np.uint64(i) * ((g << np.uint64(32)) | (g >> np.uint64(32)) | np.uint64(1))
    return ((g >> np.uint64(32)) * n_bits) >> np.uint64(32)


def fill(keys: np.ndarray, counts: np.ndarray, base: float) -> np.ndarray:
    """The bits of a filter that holds these counts."""
    q = levels(counts, base)
    n_bits = np.uint64(max(64, min(int(q.sum()) * BITS + 63 >> 6 << 6, (1 << 32) - 64)))
    bits = np.zeros(int(n_bits) >> 3, np.uint8)
    for level in range(1, int(q.max(initial=0)) + 1):
        g = _grown(keys[q >= level], level)
        for i in range(HASHES):
            at = _place(g, n_bits, i)
            np.bitwise_or.at(bits, (at >> np.uint64(3)).astype(np.int64), np.uint8(1) << (at & np.uint64(7)).astype(np.uint8))
    return bits


class Filter:
    """Filters of some shards, side by side."""

    def __init__(self, shard_bits: int, base: float, sizes: dict[int, int], rows: Iterable[tuple[int, bytes]]):
        """sizes: bytes of each shard; rows: the shards, which are copied one by one."""
        self.shard_bits, self.base = shard_bits, base
        self.bits = np.empty(sum(sizes.values()), np.uint8)
        self.start, self.size = np.zeros(1 << shard_bits, np.int64), np.zeros(1 << shard_bits, np.uint64)
        at = 0
        for s, n in sizes.items():
            self.start[s], self.size[s] = at, n * 8
            at += n
        for s, b in rows:
            self.bits[self.start[s] : self.start[s] + sizes[s]] = np.frombuffer(b, np.uint8)

    def _shard(self, keys: np.ndarray) -> np.ndarray:
        return (keys >> np.uint64(64 - self.shard_bits)).astype(np.int64)

    def level(self, keys: np.ndarray) -> np.ndarray:
        out = np.zeros(len(keys), np.int64)
        shard = self._shard(keys)
        alive = np.flatnonzero(self.size[shard] > 0)
        keys, size, start = keys[alive], self.size[shard[alive]], self.start[shard[alive]]
        for level in range(1, 255):
            g = _grown(keys, level)
            for i in range(HASHES):
                if not len(alive):
                    return out
                at = _place(g, size, i)
                on = ((self.bits[start + (at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8)) & 1).astype(bool)
                if not on.all():
                    alive, keys, size, start, g = alive[on], keys[on], size[on], start[on], g[on]
            out[alive] = level
        return out


REDUCED = "ord int, shard int, n long, total long, bits binary, keys binary, counts binary, pairs binary"


def _reduce(table: pa.Table) -> pa.Table:
    """All blobs of a shard: its filter and its exact counts, of words, or of the pairs' words before (32 bits of them) with their distinct pairs."""
    order, shard = table.column("ord")[0].as_py(), table.column("shard")[0].as_py()
    keys = np.frombuffer(b"".join(table.column("keys").to_pylist()), np.uint64)
    keys, counts = _sum(keys, np.frombuffer(b"".join(table.column("counts").to_pylist()), np.uint32).astype(np.int64))
    bits, n, total, pairs = fill(keys, counts, BASES[order]), len(keys), int(counts.sum()), None
    if order == 2:
        at = np.argsort(keys & LOW, kind="stable")
        before, counts = (keys & LOW)[at].astype(np.uint32), counts[at]
        start = np.flatnonzero(np.r_[True, before[1:] != before[:-1]])
        keys, counts, pairs = before[start], np.add.reduceat(counts, start), np.diff(np.r_[start, len(before)]).astype(np.uint32).tobytes()
    row = {"ord": [order], "shard": [shard], "n": [n], "total": [total], "bits": [bits.tobytes()], "keys": [keys.tobytes()], "counts": [counts.astype(np.int64).tobytes()], "pairs": [pairs]}
    kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary(), pa.binary()]
    return pa.table([pa.array(v, k) for v, k in zip(row.values(), kinds, strict=True)], names=list(row))


@dataclass
class Model:
    """What all passes share; weights by band of the count of the word before."""

    n_tokens: int
    n_words: int
    n_docs: int
    weights: np.ndarray


def numbers(model: Model, keys: np.ndarray, level: np.ndarray) -> np.ndarray:
    """Of each word: P(w), the most its count can be, m / high(v) and 1 - m."""
    level = level.copy()
    level[keys == START] = levels(np.array([model.n_docs]), BASES[1])[0] if model.n_docs else 0
    low, high = (x[level] for x in bounds(BASES[1]))
    high[keys == START] = model.n_docs
    weight = np.where(level > 0, model.weights[np.minimum(level // BAND, BANDS - 1)], 0.0)
    plain = (np.where(keys == START, 0, low) + 1) / (model.n_tokens + model.n_words + 1)
    return np.stack([plain, high, weight / np.maximum(high, 1), 1 - weight])


def known(words: np.ndarray, t: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Which pairs can occur: those of words that do; t and b are the places of a pair's words."""
    return np.minimum(words[1][t], words[1][b])


def log10(words: np.ndarray, t: np.ndarray, b: np.ndarray, level: np.ndarray) -> np.ndarray:
    """log10 P of each token, by the places of it and of the word before, and the level of the pair."""
    both = np.minimum(bounds(BASES[2])[0][level], known(words, t, b))
    return np.log10(words[2][b] * both + words[3][b] * words[0][t])


def counts_of(keys: np.ndarray, exact: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    if not len(exact[0]):
        return np.zeros(len(keys), np.int64)
    at = np.minimum(np.searchsorted(exact[0], keys), len(exact[0]) - 1)
    return np.where(exact[0][at] == keys, exact[1][at], 0).astype(np.int64)


class Lexicon:
    """What a task knows of words from the broadcast filter: their ``numbers`` and exact counts."""

    def __init__(self, model: Model, words: Filter, exact: tuple[np.ndarray, np.ndarray]):
        self.model, self.words, self.exact = model, words, exact
        self.keys, self.known = np.zeros(0, np.uint64), np.zeros((5, 0))

    def _new(self, keys: np.ndarray) -> np.ndarray:
        return np.concatenate([numbers(self.model, keys, self.words.level(keys)), counts_of(keys, self.exact)[None, :]])

    def of(self, keys: np.ndarray) -> np.ndarray:
        """For each of the distinct keys, a column of the five numbers."""
        out = np.empty((5, len(keys)))
        at = np.minimum(np.searchsorted(self.keys, keys), max(len(self.keys) - 1, 0))
        hit = self.keys[at] == keys if len(self.keys) else np.zeros(len(keys), bool)
        out[:, hit] = self.known[:, at[hit]]
        new = keys[~hit]
        if len(new):
            found = out[:, ~hit] = self._new(new)
            often = found[1] >= OFTEN
            if len(self.keys) > REMEMBERED:
                self.keys, self.known = self.keys[:0], self.known[:, :0]
            if often.any():
                self.keys, self.known = np.concatenate([self.keys, new[often]]), np.concatenate([self.known, found[:, often]], 1)
                order = np.argsort(self.keys, kind="stable")
                self.keys, self.known = self.keys[order], self.known[:, order]
        return out


def distinct(before: np.ndarray, token: np.ndarray) -> tuple[np.ndarray, ...]:
    """The words in order, and the places of each token and of the word before it; the pairs' keys in order, and which is each token's.

    Pairs with the same first word share a key once in 2**32, so a key tells of levels, never of words.
    """
    words, back = np.unique(np.concatenate([token, before]), return_inverse=True)
    key, pair = np.unique(pair_keys(before, token), return_inverse=True)
    return words, back[: len(token)], back[len(token) :], key, pair


def terms(lexicon: Lexicon, pairs: Filter, before: np.ndarray, token: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """log10 P of each token, and the tokens' exact counts."""
    words, t, b, key, pair = distinct(before, token)
    own = lexicon.of(words)
    level, can = np.zeros(len(key), np.int64), np.zeros(len(key), bool)
    can[pair[known(own, t, b) > 0]] = True
    level[can] = pairs.level(key[can])
    return log10(own, t, b, level[pair]), own[4][t]


def _sums(keys: np.ndarray, counts: np.ndarray, before: np.ndarray, total: np.ndarray, pairs: np.ndarray, n_docs: int) -> np.ndarray:
    """Tokens and distinct pairs by band, of words before (32 bits of them) among the words keys or, n_docs times, the start mark."""
    at = np.minimum(np.searchsorted(keys, before << np.uint64(32)), max(len(keys) - 1, 0))
    n = np.where((keys[at] >> np.uint64(32)) == before, counts[at], 0).astype(np.int64) if len(keys) else np.zeros(len(before), np.int64)
    n[before == START >> np.uint64(32)] = n_docs
    at = np.flatnonzero(n)
    band = np.minimum(levels(n[at], BASES[1]) // BAND, BANDS - 1)
    return np.stack([np.bincount(band, x[at], BANDS) for x in (total, pairs)], 1).astype(np.int64)


def _column(table: pa.Table, name: str, kind: type) -> np.ndarray:
    return np.frombuffer(b"".join(table.column(name).to_pylist()), kind)


BEFORES = pa.schema([("g", pa.int32()), ("keys", pa.binary()), ("totals", pa.binary()), ("pairs", pa.binary())])


def _regrouped(bits: int):
    """Rows of the pairs' shards, dealt by the first bits of the word before, as the words' shards are."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k, c, p in zip(batch.column("keys"), batch.column("counts"), batch.column("pairs"), strict=True):
                columns = np.frombuffer(k.as_buffer(), np.uint32), np.frombuffer(c.as_buffer(), np.int64), np.frombuffer(p.as_buffer(), np.uint32)
                ends = np.searchsorted(columns[0].astype(np.uint64) >> np.uint64(32 - bits), np.arange((1 << bits) + 1))
                rows = [(g, *(x[a:b].tobytes() for x in columns)) for g, (a, b) in enumerate(zip(ends[:-1], ends[1:], strict=True)) if b > a]
                if rows:
                    yield _rows(rows, BEFORES)

    return run


def _fitted(n_docs: int):
    schema = pa.schema([("band", pa.int32()), ("c", pa.int64()), ("t", pa.int64())])

    def run(befores: pa.Table, words: pa.Table) -> pa.Table:
        order = np.argsort(words.column("shard").to_numpy(), kind="stable")
        words = words.take(pa.array(order))
        sums = _sums(_column(words, "keys", np.uint64), _column(words, "counts", np.int64), _column(befores, "keys", np.uint32).astype(np.uint64), _column(befores, "totals", np.int64), _column(befores, "pairs", np.uint32), n_docs)
        return pa.Table.from_batches([_rows([(b, int(c), int(t)) for b, (c, t) in enumerate(sums)], schema)])

    return run


SCORED = ["n_tokens", "score", "n_known", "base_score"]


def _sums_of_texts(model: Model, at: np.ndarray, logs: np.ndarray, c: np.ndarray) -> list[pa.Array]:
    """The columns SCORED of texts whose tokens begin at ``at``."""
    base = np.log10((c + 1) / (model.n_tokens + model.n_words + 1))
    by = lambda x: pa.array(np.add.reduceat(x, at[:-1]))
    return [pa.array(np.diff(at)), by(logs), by((c > 0).astype(np.int64)), by(base)]


def _score(model: Model, words, pairs, table):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon = Lexicon(model, words.value, table.value)
        for batch in batches:
            for first, end, data, offsets in pieces(batch.column("text")):
                token, before, at = tokens(data, offsets)
                columns = _sums_of_texts(model, at, *terms(lexicon, pairs.value, before, token))
                yield pa.RecordBatch.from_arrays([batch.column("id").slice(first, end - first), *columns], names=["id", *SCORED])
        release()

    return run


def _unit(keys: np.ndarray, bits: int) -> np.ndarray:
    return (keys >> np.uint64(64 - bits)).astype(np.int64)


def _group(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``tokens`` of a group's texts, in the table's order."""
    parts = [tokens(data, offsets) for _, _, data, offsets in pieces(table.column("text"))]
    token, before = (np.concatenate(x) for x in zip(*[p[:2] for p in parts], strict=True))
    return token, before, np.cumsum(np.concatenate([[0], *[np.diff(p[2]) for p in parts]]))


PROBES = "src long, ord int, unit int, keys binary"


def _probes(bits: int):
    """A group's distinct words (ord 1) and pairs (2) in order, a row for each unit."""
    kinds = [pa.int64(), pa.int32(), pa.int32(), pa.binary()]

    def run(table: pa.Table) -> pa.Table:
        token, before, _ = _group(table)
        src, rows = table.column("src")[0].as_py(), []
        for order, keys in ((1, np.unique(np.append(token, START))), (2, np.unique(pair_keys(before, token)))):
            units = _unit(keys, bits)
            begin = np.flatnonzero(np.r_[True, units[1:] != units[:-1]])
            rows += [(src, order, u, keys[x:y].tobytes()) for u, x, y in zip(units[begin].tolist(), begin.tolist(), [*begin[1:].tolist(), len(keys)], strict=True)]
        return pa.table([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=["src", "ord", "unit", "keys"])

    return run


ANSWERS = "src long, ord int, unit int, levels binary, counts binary"


def _answers(bits: int):
    """Levels, and of words the exact counts, for the probes that have come to a unit: each distinct key is looked up once, whoever asks."""
    kinds = [pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.binary()]

    def run(probes: pa.Table, shards: pa.Table) -> pa.Table:
        columns = [[] for _ in kinds]
        if probes.num_rows:
            order, unit = probes.column("ord")[0].as_py(), probes.column("unit")[0].as_py()
            shards = shards.take(pc.sort_indices(shards, [("shard", "ascending")]))
            rows = list(zip(shards.column("shard").to_pylist(), shards.column("bits").to_pylist(), strict=True))
            own = Filter(bits, BASES[order], {s: len(b) for s, b in rows}, rows)
            asked = probes.column("keys").to_pylist()
            ends = np.cumsum([len(k) >> 3 for k in asked]).tolist()
            keys, back = np.unique(np.frombuffer(b"".join(asked), np.uint64), return_inverse=True)
            level, count = own.level(keys).astype(np.uint8)[back], None
            if order == 1:
                count = counts_of(keys, (_column(shards, "keys", np.uint64), _column(shards, "counts", np.int64)))[back]
            spans = list(zip([0, *ends[:-1]], ends, strict=True))
            columns = [probes.column("src").to_pylist(), [order] * len(spans), [unit] * len(spans), [level[x:y].tobytes() for x, y in spans], [None if count is None else count[x:y].tobytes() for x, y in spans]]
        return pa.table([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["src", "ord", "unit", "levels", "counts"])

    return run


def _joined(model: Model):
    """The scores of a group's texts, whose distinct words and pairs are found again in the order in which their levels were asked for."""

    def run(texts: pa.Table, answers: pa.Table) -> pa.Table:
        token, before, at = _group(texts)
        words, t, b, key, pair = distinct(before, token)
        answers = answers.take(pc.sort_indices(answers, [("ord", "ascending"), ("unit", "ascending")]))
        one, two = (answers.filter(pc.equal(answers.column("ord"), o)) for o in (1, 2))
        read, level = _column(one, "levels", np.uint8), _column(two, "levels", np.uint8)
        if (len(read), len(level)) != (len(words), len(key)):
            raise ValueError("the texts to score changed while they were scored")
        own = numbers(model, words, read.astype(np.int64))
        columns = _sums_of_texts(model, at, log10(own, t, b, level.astype(np.int64)[pair]), _column(one, "counts", np.int64)[t])
        return pa.table([texts.column("id"), *columns], names=["id", *SCORED])

    return run


class Trained:
    """The shards of a corpus, in the shared folder, and what is read from them."""

    def __init__(self, training: DataFrame, text_col: str = "text", max_filter: int = MAX_FILTER):
        texts = training.select(F.col(f"`{text_col}`").alias("text"))
        n_docs = texts.count()
        self.bits = min(SHARD_BITS, max(6, math.ceil(math.log2(max(n_docs, 1) / 4000 + 1))))
        blobs = texts.mapInArrow(_count(self.bits), "ord int, shard int, keys binary, counts binary")
        self.reduced = cut(blobs.groupBy("ord", "shard").applyInArrow(_reduce, REDUCED))
        sizes = {r["ord"]: r for r in self.reduced.groupBy("ord").agg(F.sum("n").alias("n"), F.sum("total").alias("total"), F.sum(F.length("bits")).alias("bytes")).collect()}
        n_words, n_tokens = (sizes[1]["n"], sizes[1]["total"]) if sizes else (0, 0)
        #: Whether all that the broadcast way needs is small enough.
        self.small = not sizes or max(sizes[1]["bytes"], sizes[2]["bytes"], 12 * n_words) <= max_filter
        self.model = Model(n_tokens, n_words, n_docs, np.zeros(BANDS))
        near = min(self.bits, 10)
        befores = self.reduced.where("ord = 2").select("keys", "counts", "pairs").mapInArrow(_regrouped(near), "g int, keys binary, totals binary, pairs binary")
        words = self.reduced.where("ord = 1").select(F.shiftright("shard", self.bits - near).alias("g"), "shard", "keys", "counts")
        found = befores.groupBy("g").cogroup(words.groupBy("g")).applyInArrow(_fitted(n_docs), "band int, c long, t long")
        sums = np.zeros((BANDS, 2))
        for r in found.groupBy("band").agg(F.sum("c").alias("c"), F.sum("t").alias("t")).collect():
            sums[r["band"]] = r["c"], r["t"]
        self.model.weights = sums[:, 0] / np.maximum(sums.sum(1), 1)

    def filter(self, order: int):
        """The broadcast filter, which passes through the driver a shard at a time."""
        rows = self.reduced.where(F.col("ord") == order)
        sizes = {r["shard"]: r["n"] for r in rows.select("shard", F.length("bits").alias("n")).collect()}  # two numbers a shard
        own = Filter(self.bits, BASES[order], sizes, ((r["shard"], r["bits"]) for r in rows.select("shard", "bits").toLocalIterator()))
        return self.reduced.sparkSession.sparkContext.broadcast(own)

    def table(self):
        """The broadcast exact counts of the words, sorted by hash."""
        rows = self.reduced.where(F.col("ord") == 1).select("shard", "keys", "counts")
        exact = sorted((r["shard"], bytes(r["keys"]), bytes(r["counts"])) for r in rows.toLocalIterator())
        counts = np.minimum(np.frombuffer(b"".join(c for *_, c in exact), np.int64), 0xFFFFFFFF).astype(np.uint32)
        return self.reduced.sparkSession.sparkContext.broadcast((np.frombuffer(b"".join(k for _, k, _ in exact), np.uint64), counts))

    def probed(self, rows: DataFrame, kind: str) -> DataFrame:
        """(id, SCORED..) of rows (id, text), with the probes sent to the filters, some groups of texts after the others."""
        size = rows.agg(F.sum(F.octet_length("text") + 1)).first()[0] or 0
        groups, rounds = size // GROUP + 1, min(ROUNDS, size // ROUND + 1)
        unit_bits = min(self.bits, max(4, math.ceil(math.log2(size / rounds / UNIT + 1))))
        rows = rows.withColumn("src", F.pmod(F.xxhash64("id", "text"), F.lit(groups)))  # the same whenever it is computed
        unit = F.shiftright("shard", self.bits - unit_bits).alias("unit")
        words = [F.when(F.col("ord") == 1, F.col(c)).alias(c) for c in ("keys", "counts")]
        filters = self.reduced.select("ord", unit, "shard", "bits", *words)
        answers = []
        for i in range(rounds):
            asking = rows.where(F.col("src") % rounds == i).select("src", "text")
            probes = asking.groupBy("src").applyInArrow(_probes(unit_bits), PROBES)
            answers.append(cut(probes.groupBy("ord", "unit").cogroup(filters.groupBy("ord", "unit")).applyInArrow(_answers(self.bits), ANSWERS)))
        schema = f"id {kind}, n_tokens long, score double, n_known long, base_score double"
        return rows.groupBy("src").cogroup(reduce(DataFrame.union, answers).groupBy("src")).applyInArrow(_joined(self.model), schema)


def score(docs: DataFrame, training: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_filter: int = MAX_FILTER) -> DataFrame:
    """(id, n_tokens, n_known, train_tokens, base_score, score) for each row of docs, learnt from the texts of training."""
    own = Trained(training, text_col, max_filter)
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    kind = rows.dtypes[0][1]
    if own.small:
        schema = f"id {kind}, n_tokens long, score double, n_known long, base_score double"
        out = rows.mapInArrow(_score(own.model, own.filter(1), own.filter(2), own.table()), schema)
    else:
        out = own.probed(rows, kind)
    return out.select(F.col("id").alias(id_col), "n_tokens", "n_known", F.lit(own.model.n_tokens).cast("long").alias("train_tokens"), "base_score", "score")
