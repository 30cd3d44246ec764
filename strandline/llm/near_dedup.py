"""Near-duplicate documents by a chosen-path similarity join on word shingles.

Documents with the same shingles are one class. Each class has a sketch of ``POSITIONS`` minwise tokens. In each of
several independent trees a node sends its classes to one child for each distinct token at a position that the node
selects (a second position with the chance that makes 1 / similarity children on average, so a similar pair stays together in one
child on average). Nodes with ``LEAF`` classes or fewer are compared exhaustively; larger ones branch on, ``DEPTHS[-1]``
levels at most. The number of trees follows from the recall that is asked for at that depth.

Comparing in a node uses sketches and set sizes; pairs that come near are candidates. The first look names the
spanning forest of a node's candidates with the highest estimates; nodes that are still large at the last depth, groups of
close copies, are dealt into chunks for it. These candidates are confirmed on full sets, each component's best before
the others. The second look compares what is left exhaustively: in each node the classes of unlike components, of a large
node its classes outside its largest component against all, in blocks. Those that come near are set against each
other on their full sets within the node, and only a forest of links between components leaves it. So no pair of a
node is left out, a group of m copies costs about m confirmations for each tree, and nothing is sent for each pair.

Words are split at ASCII white space with A-Z lower-cased. A text with fewer words than a shingle is one shingle; a
null text or one without words has no shingles and is linked with nothing. Rows with the same id keep apart unless their texts
link. A null id gives way to any other as component id. An empty table gives an empty result. ``deduplicate`` ignores other
columns; ``keep_first`` returns whole rows whatever their columns. Shingles and classes are 64-bit hashes.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandline.llm._common import cut, small
from strandline.llm._components import components
from strandline.llm._tokens import mix, pieces, shingles, word_hashes

POSITIONS = 128
LEAF = 24
DEPTHS = (2, 4, 8)
#: Share of the pairs at the similarity itself that meet in a node of the last depth, in any tree; closer ones meet more often.
RECALL = 0.999
#: Standard errors of the sketch's estimate that a pair may lie below the similarity and still be a candidate.
MARGIN = 4.0
#: Classes in a block of a large node.
BLOCK = 512
#: Tokens that a node's full sets are set against each other by at a time.
SLICE = 4096

_MULTIPLY = np.random.default_rng(97).integers(1, 1 << 31, POSITIONS, dtype=np.uint64).astype(np.uint32) * np.uint32(2) + np.uint32(1)


def survival(similarity: float, depth: int) -> float:
    """Chance that a pair of this similarity is still together in some node at this depth of a tree."""
    q, second = 1.0, 1 / similarity - 1
    for _ in range(depth):
        both = similarity * q
        q = (1 - second) * both + second * (1 - (1 - both) ** 2)
    return q


def trees(similarity: float, recall: float = RECALL, depth: int = DEPTHS[-1]) -> int:
    return max(1, math.ceil(math.log(1 - recall) / math.log(1 - survival(similarity, depth))))


def sketch(tokens: np.ndarray) -> np.ndarray:
    """The least of the multiplied tokens for each position."""
    high = (tokens >> np.uint64(32)).astype(np.uint32)
    out = np.full(POSITIONS, 0xFFFFFFFF, np.uint32)
    for a in range(0, len(high), 4096):
        out = np.minimum(out, (high[None, a : a + 4096] * _MULTIPLY[:, None]).min(1))
    return out


def _sets(column: pa.Array, width: int) -> Iterator[np.ndarray]:
    for _, _, data, offsets in pieces(column):
        yield from shingles(*word_hashes(data, offsets), width)


def _key(tokens: np.ndarray) -> int:
    return xxhash.xxh3_64_intdigest(tokens.tobytes()) - (1 << 63)


def _signatures(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            key, n, sketches = [], [], []
            for s in _sets(batch.column(2), width):
                n.append(len(s))
                key.append(_key(s) if len(s) else None)
                sketches.append(sketch(s).tobytes() if len(s) else None)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(key, pa.int64()), pa.array(n, pa.int64()), pa.array(sketches, pa.binary())], names=["id", "h", "k", "n", "sketch"])

    return run


def _step(h: np.ndarray, rows: np.ndarray, sketches: np.ndarray, second: float) -> tuple[np.ndarray, np.ndarray]:
    """Children of the nodes h that the rows are in."""
    again = mix(h + np.uint64(0xA24BAED4963EE407)) < np.uint64(int(second * 2.0**64))
    outs, at = [], []
    for salt, own in ((np.uint64(1), slice(None)), (np.uint64(0x9FB21C651E98DF25), again)):
        g, r = h[own], rows[own]
        position = mix(g ^ salt) % np.uint64(POSITIONS)
        token = sketches[r, position.astype(np.int64)].astype(np.uint64)
        outs.append(mix(g * np.uint64(0xD1342543DE82EF95) + mix((position << np.uint64(32)) | token)))
        at.append(r)
    return np.concatenate(outs), np.concatenate(at)


def _descend(n_trees: int, levels: int, second: float):
    """From (node, k, sketch), or (k, sketch) at the roots, to (node, k) some levels below."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for a in range(0, whole.num_rows, 2000):
                batch = whole.slice(a, 2000)
                k = batch.column("k").to_numpy()
                sketches = np.frombuffer(b"".join(batch.column("sketch").to_pylist()), np.uint32).reshape(-1, POSITIONS)
                rows = np.arange(len(k))
                if "node" in batch.schema.names:
                    h = batch.column("node").to_numpy().view(np.uint64)
                else:
                    h = np.repeat(mix(np.arange(1, n_trees + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)), len(k))
                    rows = np.tile(rows, n_trees)
                for _ in range(levels):
                    h, rows = _step(h, rows, sketches, second)
                yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(k[rows])], names=["node", "k"])

    return run


def _forest(i: np.ndarray, j: np.ndarray, est: np.ndarray) -> np.ndarray:
    """Which edges make the spanning forest with the highest estimates."""
    root = {x: x for x in np.concatenate([i, j]).tolist()}
    kept = []
    for e in np.argsort(-est, kind="stable").tolist():
        a, b = int(i[e]), int(j[e])
        while root[a] != a:
            root[a] = root[root[a]]
            a = root[a]
        while root[b] != b:
            root[b] = root[root[b]]
            b = root[b]
        if a != b:
            root[a] = b
            kept.append(e)
    return np.array(kept, np.int64)


def _held(batches: Iterator[pa.RecordBatch], arrays, compare) -> Iterator[pa.RecordBatch]:
    """compare(runs, unit, *arrays) for the rows of each unit together, from batches sorted by unit; a unit lies between two of the runs."""
    held: list[tuple] = []
    for whole in batches:
        for a in range(0, whole.num_rows, 20_000):
            batch = whole.slice(a, 20_000)
            held.append((batch.column("unit").to_numpy(), *arrays(batch)))
            unit, *rest = (np.concatenate(x) for x in zip(*held, strict=True))
            runs = np.flatnonzero(np.r_[True, unit[1:] != unit[:-1]])
            if len(runs) > 1:
                yield from compare(runs, unit, *rest)
            last = runs[-1]  # its unit may go on
            held = [(unit[last:], *(x[last:] for x in rest))]
    if held:
        unit, *rest = held[0]
        yield from compare(np.array([0, len(unit)]), unit, *rest)


def _bits(batch: pa.RecordBatch) -> np.ndarray:
    return np.frombuffer(b"".join(batch.column("bits").to_pylist()), np.uint8).reshape(-1, POSITIONS)


class _Near:
    """Whether rows come near, by sizes and sketches; -1 for those that don't or that have one label."""

    def __init__(self, percent: int):
        similarity = percent / 100
        self.percent, self.least = percent, similarity - MARGIN * math.sqrt(similarity * (1 - similarity) / POSITIONS)

    def __call__(self, same: np.ndarray, n: tuple[np.ndarray, np.ndarray], label: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
        est = (same / POSITIONS - 1 / 256) / (1 - 1 / 256)
        sizes = 100 * np.minimum(*n) >= self.percent * np.maximum(*n)
        return np.where((est >= self.least) & sizes & (label[0] != label[1]), est, -1.0)

    def rows(self, left: np.ndarray, right: np.ndarray, bits: np.ndarray, n: np.ndarray, label: np.ndarray) -> np.ndarray:
        """A matrix of estimates, from places to places."""
        same = np.stack([(bits[right] == bits[i]).sum(1, dtype=np.int16) for i in left])
        return self(same, (n[left][:, None], n[right][None, :]), (label[left][:, None], label[right][None, :]))


def _forests(percent: int):
    """(a, b, est) of a spanning forest for each unit's candidates, from rows (unit, k, n, bits)."""
    near = _Near(percent)

    def compare(runs: np.ndarray, unit: np.ndarray, k: np.ndarray, n: np.ndarray, bits: np.ndarray) -> Iterator[pa.RecordBatch]:
        found = []
        size = np.diff(runs)
        two = runs[:-1][size == 2]
        for a in range(0, len(two), 10_000):
            i = two[a : a + 10_000]
            est = near((bits[i] == bits[i + 1]).sum(1), (n[i], n[i + 1]), (k[i], k[i + 1]))
            found.append((k[i][est >= 0], k[i + 1][est >= 0], est[est >= 0]))
        for a, s in zip(runs[:-1][size > 2].tolist(), size[size > 2].tolist(), strict=True):
            rows = np.arange(a, a + s)
            est = np.triu(near.rows(rows, rows, bits, n, k), 1)
            i, j = np.nonzero(est > 0)
            kept = _forest(i, j, est[i, j])
            found.append((k[a + i[kept]], k[a + j[kept]], est[i[kept], j[kept]]))
        if found:
            x, y, est = (np.concatenate(c) for c in zip(*found, strict=True))
            yield pa.RecordBatch.from_arrays([pa.array(np.minimum(x, y)), pa.array(np.maximum(x, y)), pa.array(est)], names=["a", "b", "est"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _held(batches, lambda b: (b.column("k").to_numpy(), b.column("n").to_numpy(), _bits(b)), compare)

    return run


def _sides(side: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the rows that are set against others, and of the others: all against all, or side 1 against side 2."""
    return (np.flatnonzero(side == 1), np.flatnonzero(side == 2)) if side.max() > 0 else (np.arange(len(side)), np.arange(len(side)))


def _open(percent: int):
    """What comes near under another label, from rows (unit, side, k, label, n, bits): (unit, side, k, label, other).

    Pairs (k, other), if the unit has no more of them than twice its rows; else its rows that are in any, without other.
    """
    near = _Near(percent)
    names = ["unit", "side", "k", "label", "other"]

    def compare(runs: np.ndarray, unit: np.ndarray, side: np.ndarray, k: np.ndarray, label: np.ndarray, n: np.ndarray, bits: np.ndarray) -> Iterator[pa.RecordBatch]:
        live, first, second = np.zeros(len(unit), bool), [], []
        for a, s in zip(runs[:-1].tolist(), np.diff(runs).tolist(), strict=True):
            own = slice(a, a + s)
            if (label[own] == label[a]).all():
                continue
            left, right = (a + x for x in _sides(side[own]))
            some, found = [], 0
            for b in range(0, len(left), 64):
                ok = near.rows(left[b : b + 64], right, bits, n, label) >= 0
                live[left[b : b + 64]] |= ok.any(1)
                live[right] |= ok.any(0)
                found += int(ok.sum())
                if found <= 4 * s:
                    some.append(np.stack([left[b : b + 64][i] if x else right[i] for x, i in zip((1, 0), np.nonzero(ok), strict=True)]))
            pairs = np.sort(np.concatenate(some, 1), 0) if found <= 4 * s and some else None
            if pairs is not None and (pairs := np.unique(pairs, axis=1)).shape[1] <= 2 * s:
                live[own] = False
                first.append(pairs[0])
                second.append(pairs[1])
        rows = [x[live] for x in (unit, side, k, label)]
        yield pa.RecordBatch.from_arrays([*(pa.array(x) for x in rows), pa.nulls(len(rows[0]), pa.int64())], names=names)
        if first:
            i, j = np.concatenate(first), np.concatenate(second)
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in (unit[i], side[i], k[i], label[i], k[j])], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _held(batches, lambda b: (*(b.column(c).to_numpy() for c in ("side", "k", "label", "n")), _bits(b)), compare)

    return run


def common(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Sizes of the intersections of sets, from places to places, by products over a slice of the tokens at a time."""
    size = np.array([len(s) for s in sets])
    token, back, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    row = np.repeat(np.arange(len(sets)), size)
    shared = times > 1
    number = np.cumsum(shared) - 1
    keep = shared[back]
    row, column = row[keep], number[back[keep]]
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    out = np.zeros((len(left), len(right)), np.float64)
    for a in range(0, int(shared.sum()), SLICE):
        one, two = np.searchsorted(column, [a, a + SLICE])
        dense = np.zeros((len(sets), SLICE), np.float32)
        dense[row[one:two], column[one:two] - a] = 1
        out += dense[left] @ dense[right].T  # whole numbers below 2 ** 24 are exact
    return out


def _links(percent: int):
    """(a, b) of a forest of each unit's links between labels, from rows (unit, side, k, label, tokens)."""

    def compare(runs: np.ndarray, unit: np.ndarray, side: np.ndarray, k: np.ndarray, label: np.ndarray, tokens: np.ndarray) -> Iterator[pa.RecordBatch]:
        first, second = [], []
        for a, b in zip(runs[:-1].tolist(), runs[1:].tolist(), strict=True):
            sets = [np.frombuffer(t, np.uint64) for t in tokens[a:b]]
            n, own = np.array([len(s) for s in sets]), label[a:b]
            left, right = _sides(side[a:b])
            if not len(left) or not len(right) or (own == own[0]).all():
                continue
            both = common(sets, left, right)
            ok = (100 * both >= percent * (n[left][:, None] + n[right][None, :] - both)) & (own[left][:, None] != own[right][None, :])
            i, j = np.nonzero(ok)
            _, one = np.unique(np.stack([own[left[i]], own[right[j]]]), axis=1, return_index=True)  # a link for each two labels
            i, j = left[i[one]], right[j[one]]
            _, node = np.unique(np.concatenate([own[i], own[j]]), return_inverse=True)
            kept = _forest(node[: len(i)], node[len(i) :], both[np.searchsorted(left, i), np.searchsorted(right, j)])
            first.append(k[a + i[kept]])
            second.append(k[a + j[kept]])
        if first:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in (first, second)], names=["a", "b"])

    def arrays(batch: pa.RecordBatch) -> tuple:
        tokens = np.empty(batch.num_rows, object)
        tokens[:] = batch.column("tokens").to_pylist()
        return (*(batch.column(c).to_numpy() for c in ("side", "k", "label")), tokens)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        small = (part.slice(a, 500) for part in batches for a in range(0, part.num_rows, 500))
        return _held(small, arrays, compare)

    return run


def _low_bytes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        bits = [(np.frombuffer(s, np.uint32) & np.uint32(255)).astype(np.uint8).tobytes() for s in batch.column("sketch").to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column("k"), batch.column("n"), pa.array(bits, pa.binary())], names=["k", "n", "bits"])


def nodes(classes: DataFrame, percent: int, recall: float) -> tuple[DataFrame, DataFrame]:
    """(node, k) of the classes (k, sketch): nodes small enough to be compared exhaustively, and those still large at the last depth."""
    similarity = percent / 100
    second, n_trees = 1 / similarity - 1, trees(similarity, recall)
    rows = classes.select("k", "sketch").mapInArrow(_descend(n_trees, DEPTHS[0], second), "node long, k long")
    leaves, large = [], None
    for depth, deeper in zip(DEPTHS, (*DEPTHS[1:], None), strict=True):
        counted = cut(rows.groupBy("node").agg(F.count("*").alias("c")).where("c > 1"))  # written, so Spark can split a node that many rows join
        rows = cut(rows.join(counted, "node"))
        leaves.append(rows.where(F.col("c") <= LEAF).select("node", "k"))
        large = rows.where(F.col("c") > LEAF).select("node", "k")
        if deeper is None or large.isEmpty():
            break
        met = large.join(classes.select("k", "sketch"), "k").repartition(F.xxhash64("node", "k"))  # neither nodes nor classes alone are even
        rows = met.mapInArrow(_descend(n_trees, deeper - depth, second), "node long, k long")
    return cut(reduce(DataFrame.union, leaves)), cut(large)


def _dealt(rows: DataFrame) -> DataFrame:
    return rows.repartition("unit").sortWithinPartitions("unit")


def forests(small: DataFrame, large: DataFrame, bits: DataFrame, percent: int) -> DataFrame:
    """(a, b, est) with a < b: the first look. Large nodes are dealt into chunks of about LEAF classes."""
    counted = cut(large.groupBy("node").agg(F.count("*").alias("c")))
    chunk = F.pmod(F.xxhash64("k", "node"), F.ceil(F.col("c") / LEAF))
    units = small.select(F.col("node").alias("unit"), "k").union(large.join(counted, "node").select(F.xxhash64("node", chunk).alias("unit"), "k"))
    met = _dealt(units.join(bits, "k").select("unit", "k", "n", "bits")).mapInArrow(_forests(percent), "a long, b long, est double")
    return cut(met.groupBy("a", "b").agg(F.max("est").alias("est")))


def units(small: DataFrame, large: DataFrame, ends: DataFrame, labels: DataFrame) -> DataFrame:
    """(unit, side, k, label): the second look. ends (k): all classes with a candidate; others of small nodes have none there."""
    own = F.coalesce("label", "k").alias("label")
    few = small.join(ends, "k", "left_semi").join(labels, "k", "left").select("node", "k", own)
    mixed = cut(few.groupBy("node").agg(F.min("label").alias("one"), F.max("label").alias("two")).where("one != two").select("node"))
    few = few.join(mixed, "node").select(F.col("node").alias("unit"), F.lit(0).alias("side"), "k", "label")
    many = cut(large.join(labels, "k", "left").select("node", "k", own))
    counts = many.groupBy("node", "label").agg(F.count("*").alias("m")).groupBy("node")
    counts = cut(counts.agg(F.sum("m").alias("c"), F.max(F.struct("m", "label")).alias("most")).where("c > most.m"))
    blocks = lambda n: F.ceil(n / BLOCK).cast("int")
    many = many.join(counts, "node").withColumn("outside", F.col("label") != F.col("most.label"))
    many = many.withColumn("lefts", blocks(F.col("c") - F.col("most.m"))).withColumn("rights", blocks(F.col("c")))
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    place = lambda n: F.pmod(F.xxhash64("k"), F.col(n)).cast("int")
    left = many.where("outside").select("node", F.lit(1).alias("side"), "k", "label", place("lefts").alias("i"), every("rights").alias("j"))
    right = many.select("node", F.lit(2).alias("side"), "k", "label", place("rights").alias("j"), every("lefts").alias("i"))
    both = left.unionByName(right).select(F.xxhash64("node", "i", "j").alias("unit"), "side", "k", "label")
    return few.union(both)


def _confirm(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ok = []
            for x, y in zip(batch.column("x"), batch.column("y"), strict=True):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                at = np.searchsorted(y, x)
                both = int((y[np.minimum(at, len(y) - 1)] == x).sum())
                ok.append(100 * both >= percent * (len(x) + len(y) - both))
            yield batch.select(["a", "b"]).filter(pa.array(ok, pa.bool_()))

    return run


class _Links:
    """Confirmed links, and the components that they make."""

    def __init__(self, sets: DataFrame, percent: int):
        self.sets, self.percent = sets, percent
        self.links: DataFrame | None = None
        self.labels: DataFrame | None = None

    def between(self, pairs: DataFrame) -> DataFrame:
        """The pairs whose ends are in different components, with these as la and lb."""
        if self.labels is None:
            return pairs.select("a", "b", "est", F.col("a").alias("la"), F.col("b").alias("lb"))
        of = lambda k, name: self.labels.select(F.col("k").alias(k), F.col("label").alias(name))
        live = pairs.join(of("a", "la"), "a", "left").join(of("b", "lb"), "b", "left")
        return live.select("a", "b", "est", F.coalesce("la", "a").alias("la"), F.coalesce("lb", "b").alias("lb")).where("la != lb")

    def confirmed(self, pairs: DataFrame) -> DataFrame:
        left = pairs.select("a", "b").join(self.sets.select(F.col("k").alias("a"), F.col("tokens").alias("x")), "a")
        both = left.join(self.sets.select(F.col("k").alias("b"), F.col("tokens").alias("y")), "b").select("a", "b", "x", "y")
        return both.mapInArrow(_confirm(self.percent), "a long, b long")

    def add(self, found: DataFrame) -> None:
        self.links = cut(found if self.links is None else self.links.union(found))
        self.labels = components(self.links).select(F.col("node").alias("k"), F.col("component").alias("label"))


def connect(small: DataFrame, large: DataFrame, first: DataFrame, bits: DataFrame, sets: DataFrame, percent: int, rounds: int = 2) -> DataFrame | None:
    """(k, label): components on full sets (k, tokens), from the nodes and the first look's candidates."""
    state, live = _Links(sets, percent), first
    for turn in range(rounds + 1):
        live = cut(state.between(live))
        if live.isEmpty():
            break
        some = live
        if turn < rounds:
            best = live.select("la", "est", "a", "b").union(live.select("lb", "est", "a", "b")).groupBy("la").agg(F.max(F.struct("est", "a", "b")).alias("e"))
            some = cut(best.select("e.a", "e.b").distinct())
            live = live.select("a", "b", "est").join(some, ["a", "b"], "left_anti")
        state.add(state.confirmed(some))
    if state.labels is None:
        return None
    ends = first.select(F.col("a").alias("k")).union(first.select("b")).distinct()
    rows = units(small, large, ends, state.labels).join(bits, "k").select("unit", "side", "k", "label", "n", "bits")
    near = cut(_dealt(rows).mapInArrow(_open(percent), "unit long, side int, k long, label long, other long"))
    if near.isEmpty():
        return state.labels
    pairs = near.where("other is not null").select(F.least("k", "other").alias("a"), F.greatest("k", "other").alias("b")).distinct()
    crowds = near.where("other is null").join(sets, "k").select("unit", "side", "k", "label", "tokens")
    state.add(state.confirmed(pairs.join(first, ["a", "b"], "left_anti")).union(_dealt(crowds).mapInArrow(_links(percent), "a long, b long")))
    return state.labels


def _resolved(docs: DataFrame, width: int, percent: int, recall: float, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    """Rows (id, h, k, n) of docs, h a hash of the text, and classes (k, first) with the component's first row: its id and h, nulls last."""
    kind = docs.select(F.col(f"`{id_col}`").alias("id")).dtypes[0][1]
    text = F.col(f"`{text_col}`")
    slim = docs.select(F.col(f"`{id_col}`").alias("id"), F.xxhash64(text).alias("h"), text.alias("text"))
    base = cut(slim.mapInArrow(_signatures(width), f"id {kind}, h long, k long, n long, sketch binary"))
    who = F.struct(F.col("id").isNull().alias("none"), "id", "h")
    grouped = base.where("k is not null").groupBy("k")
    classes = cut(grouped.agg(F.min(who).alias("rep"), F.first("n").alias("n"), F.first("sketch").alias("sketch")))
    few, many = nodes(classes, percent, recall)
    bits = cut(classes.select("k", "n", "sketch").mapInArrow(_low_bytes, "k long, n long, bits binary"))
    pairs = forests(few, many, bits, percent)
    wanted = pairs.select(F.col("a").alias("k")).union(pairs.select("b")).union(many.select("k")).distinct()
    wanted = cut(wanted.join(classes.select("k", "rep"), "k").select("k", "rep.id", "rep.h"))

    def tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for a in range(0, whole.num_rows, 500):
                batch = whole.slice(a, 500)
                found = [(_key(s) if len(s) else None, s.tobytes()) for s in _sets(batch.column("text"), width)]
                same = [k == w for (k, _), w in zip(found, batch.column("k").to_pylist(), strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in found], pa.int64()), pa.array([s for _, s in found], pa.binary())], names=["k", "tokens"]).filter(pa.array(same, pa.bool_()))

    of = small(wanted, wanted.count(), 500_000)  # beyond the bound the texts are shuffled by id and hash, one class for each
    on = F.col("d.id").eqNullSafe(F.col("w.id")) & (F.col("d.h") == F.col("w.h"))
    sets = cut(slim.alias("d").join(of.alias("w"), on).select("w.k", "d.text").mapInArrow(tokens, "k long, tokens binary").dropDuplicates(["k"]))
    labels = connect(few, many, pairs, bits, sets, percent)
    labels = classes.select("k", F.col("k").alias("label")).limit(0) if labels is None else labels
    named = classes.select("k", "rep").join(labels, "k", "left").select("k", "rep", F.coalesce("label", "k").alias("label"))
    least = cut(named.groupBy("label").agg(F.min("rep").alias("first")))
    return base.drop("sketch"), cut(named.join(least, "label").select("k", "first"))


def deduplicate(docs: DataFrame, width: int = 5, percent: int = 80, recall: float = RECALL, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_shingles, component_id) for each row of docs, linking rows whose shingle sets have a Jaccard similarity of percent / 100."""
    base, found = _resolved(docs, width, percent, recall, id_col, text_col)
    out = base.select("id", "k", "n").join(found, "k", "left")
    own = F.when(F.col("k").isNull(), F.col("id")).otherwise(F.col("first.id"))
    return out.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), own.alias("component_id"))


def keep_first(docs: DataFrame, width: int = 5, percent: int = 80, recall: float = RECALL, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs without all rows of each component but its first, by id (nulls last) and the text's hash.

    Rows that repeat id and text are one document, of which one row stays. Documents without words all stay.
    """
    base, found = _resolved(docs, width, percent, recall, id_col, text_col)
    rows = base.select("id", "h", "k").join(found, "k", "left")
    later = F.col("k").isNotNull() & ~(F.col("id").eqNullSafe(F.col("first.id")) & (F.col("h") == F.col("first.h")))
    rows = cut(rows.groupBy("id", "h").agg(F.max(later).alias("later"), F.count("*").alias("rows")).where("later or rows > 1"))
    of = small(rows, rows.count(), 500_000)
    own = [F.col(f"`{c}`") for c in docs.columns]
    whole = docs.select(F.struct(*own).alias("row"), F.col(f"`{id_col}`").alias("id"), F.xxhash64(F.col(f"`{text_col}`")).alias("h"))
    whole = whole.alias("d").join(of.alias("r"), F.col("d.id").eqNullSafe(F.col("r.id")) & (F.col("d.h") == F.col("r.h")), "left")
    whole = whole.where(~F.coalesce("later", F.lit(False))).select("row", "d.id", "d.h", "rows")
    once = whole.where("rows is null").select("row.*")
    if rows.where("rows > 1 and not later").isEmpty():
        return once
    return once.union(whole.where("rows is not null").dropDuplicates(["id", "h"]).select("row.*"))
