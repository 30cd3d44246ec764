"""Near-duplicate embeddings by randomised-rotation binary codes with correction factors.

A unit vector is rotated at random and stored as its signs plus one factor, the inner product of the vector with its
own sign vector; from these and another vector's scalar-quantised rotation an inner product is estimated without
bias, and the factor bounds the estimate's error. Codes of several rotations are stored, once for each vector, and looked at one
after the other: a pair goes on to the next while its upper bound reaches the threshold, and what all of them leave is recomputed in
double precision, so no link rests on an estimate.

Pairs are looked for among vectors that agree on all signs of one of several bands of rotated coordinates. Bands are
as wide as the number of vectors asks for and as many as the recall asks for. A bucket with more than ``BLOCK`` vectors is
compared block against block, each pair of blocks a unit of its own, so one common direction is spread over many
tasks; links are counted where they are found (in the first band that a pair shares) and only a spanning forest of a
unit leaves it. Identical vectors are one class with a weight. A vector travels with its codes, once for each band and
block, in the precision it came in: the pairs that need it are met where they are found and none is sent.

Null vectors, and those that are zero or hold a null or non-finite component, are linked with nothing; vectors are
scaled before they are squared, so none over- or underflows. Vectors of different lengths aren't compared. Rows with the same id
keep apart unless their vectors link. Other columns are ignored. An empty table gives an empty result. Classes are
64-bit hashes of the components.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandline.llm._common import cut, small
from strandline.llm._components import components
from strandline.llm._tokens import mix

BLOCK = 1024
#: Vectors in a bucket, on average, that the bands' width is chosen for.
BUCKET = 512
RECALL = 0.9995
CODE_BITS = 256
#: Width of the confidence bounds, in standard errors.
WIDTH = 5.0


def rotation(dim: int, number: int) -> np.ndarray:
    """One of the random orthogonal matrices of a dimension."""
    q, r = np.linalg.qr(np.random.default_rng((dim, number)).standard_normal((dim, dim)))
    return q * np.sign(np.diag(r))


def bands(n: int, threshold: float, recall: float = RECALL) -> tuple[int, int]:
    """Signs in a band, and bands, for n vectors."""
    width = min(60, max(5, math.ceil(math.log2(max(n, 2) / BUCKET))))
    agree = (1 - math.acos(threshold) / math.pi) ** width
    return width, math.ceil(math.log(1 - recall) / math.log(1 - agree))


def _vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, k, vector): the class and the bytes of each vector, float32 if the column is, null if it can't be compared."""
    for batch in batches:
        key, data = [], []
        kind = np.float32 if batch.column(1).type.value_type == pa.float32() else np.float64
        column = batch.column(1).cast(pa.large_list(pa.from_numpy_dtype(kind)))
        for v in column:
            x = v.values.to_numpy(zero_copy_only=False).astype(kind) if v.is_valid else np.zeros(0, kind)
            good = bool(np.isfinite(x).all() and x.any())
            key.append(xxhash.xxh3_64_intdigest(x.tobytes()) - (1 << 63) if good else None)
            data.append(x.tobytes() if good else None)
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(key, pa.int64()), pa.array(data, pa.binary())], names=["id", "k", "vector"])


def _units(vectors: list[bytes], kind: type) -> np.ndarray:
    """Unit vectors in double precision, scaled by their largest component first."""
    x = np.frombuffer(b"".join(vectors), kind).reshape(len(vectors), -1).astype(np.float64)
    x = x / np.abs(x).max(1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


class Coder:
    """Signs, factors and quantised rotations of unit vectors of one dimension."""

    def __init__(self, dim: int):
        self.dim = dim
        self.turns = [rotation(dim, i) for i in range(max(1, math.ceil(CODE_BITS / dim)))]

    def encode(self, unit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sign vectors (turn, vector, words of 64 signs) and correction factors (turn, vector)."""
        signs, factors = [], []
        for t in self.turns:
            z = unit @ t
            signs.append(_pack(z > 0))
            factors.append(np.abs(z).sum(1) / math.sqrt(self.dim))
        return np.stack(signs), np.stack(factors)

    def _quantised(self, unit: np.ndarray, turn: int, rng: np.random.Generator) -> tuple[np.ndarray, ...]:
        """A rotation rounded at random to four bits, which keeps estimates unbiased: the planes of bits, their sums, and the least value and step."""
        z = unit @ self.turns[turn]
        low = z.min(1, keepdims=True)
        step = np.maximum((z.max(1, keepdims=True) - low) / 15, 1e-12)
        q = np.clip(np.floor((z - low) / step + rng.random(z.shape)), 0, 15).astype(np.uint8)
        planes = np.stack([_pack((q >> bit) & 1 > 0) for bit in range(4)], 1)
        return planes, q.sum(1, dtype=np.int64), low[:, 0], step[:, 0]

    def _turn(self, inner: np.ndarray, ones: np.ndarray, factor: np.ndarray, q: np.ndarray, low: np.ndarray, step: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Estimates of one rotation and their variances."""
        whole = 2 * (step * inner + low * ones) - (step * q + low * self.dim)
        variance = (1 - np.minimum(factor, 1) ** 2) / factor**2 / max(1, self.dim - 1)
        return whole / math.sqrt(self.dim) / factor, variance + (step**2 / 4) / factor**2

    def estimate(self, unit: np.ndarray, signs: np.ndarray, factors: np.ndarray, turns: int | None = None, seed: int = 5) -> tuple[np.ndarray, np.ndarray]:
        """Inner products (query, coded) and half-widths of their confidence intervals, mean over the turns."""
        turns = len(self.turns) if turns is None else turns
        total, spread = np.zeros((len(unit), signs.shape[1])), np.zeros((len(unit), signs.shape[1]))
        rng = np.random.default_rng(seed)
        for t in range(turns):
            planes, q, low, step = self._quantised(unit, t, rng)
            code, inner = signs[t], np.zeros(total.shape)
            for bit in range(4):
                inner += (1 << bit) * np.bitwise_count(planes[:, bit][:, None, :] & code[None, :, :]).sum(2, dtype=np.int64)
            est, variance = self._turn(inner, np.bitwise_count(code).sum(1, dtype=np.int64)[None, :], factors[t][None, :], q[:, None], low[:, None], step[:, None])
            total += est
            spread += variance
        return total / turns, WIDTH * np.sqrt(spread) / turns

    def near(self, unit: np.ndarray, signs: np.ndarray, factors: np.ndarray, threshold: float, seed: int = 5) -> tuple[np.ndarray, np.ndarray]:
        """Places of the pairs (query, coded) whose upper bound reaches the threshold after each of the turns."""
        est, half = self.estimate(unit, signs, factors, 1, seed)
        i, j = np.nonzero(est + half >= threshold)
        total, spread = est[i, j], (half[i, j] / WIDTH) ** 2
        rng = np.random.default_rng(seed + 1)
        for t in range(1, len(self.turns)):
            if not len(i):
                break
            planes, q, low, step = self._quantised(unit, t, rng)
            code = signs[t][j]
            inner = sum((1 << bit) * np.bitwise_count(planes[i, bit] & code).sum(1, dtype=np.int64) for bit in range(4))
            est, variance = self._turn(inner, np.bitwise_count(code).sum(1, dtype=np.int64), factors[t][j], q[i], low[i], step[i])
            total, spread = total + est, spread + variance
            open_ = total / (t + 1) + WIDTH * np.sqrt(spread) / (t + 1) >= threshold
            i, j, total, spread = i[open_], j[open_], total[open_], spread[open_]
        return i, j


def _pack(bits: np.ndarray) -> np.ndarray:
    """Rows of bits as words of 64."""
    packed = np.packbits(bits, axis=1)
    packed = np.pad(packed, ((0, 0), (0, -packed.shape[1] % 8)))
    return packed.view(np.uint64)


def _coded(width: int, n_bands: int, kind: type):
    """(k, w, vector) to (k, w, vector, signs, factors, bands, keys): the codes, the bands' signs, and a hash of each band's."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for a in range(0, whole.num_rows, 2000):
                batch = whole.slice(a, 2000)
                size = pc.binary_length(batch.column("vector")).to_numpy() // np.dtype(kind).itemsize
                for dim in np.unique(size).tolist():
                    part = batch.filter(pa.array(size == dim))
                    x = _units(part.column("vector").to_pylist(), kind)
                    signs, factors = Coder(dim).encode(x)
                    turns = math.ceil(width * n_bands / dim)
                    bits = np.concatenate([x @ rotation(dim, 1000 + i) > 0 for i in range(turns)], 1)[:, : width * n_bands]
                    keys = mix(_values(bits, width) ^ mix(np.arange(n_bands, dtype=np.uint64) + np.uint64(dim << 20))[None, :]).view(np.int64)
                    lists = pa.FixedSizeListArray.from_arrays(pa.array(keys.ravel()), n_bands).cast(pa.list_(pa.int64()))
                    stored = [np.ascontiguousarray(c.swapaxes(0, 1)) for c in (signs, factors.astype(np.float32))]
                    codes = [pa.array([r.tobytes() for r in c], pa.binary()) for c in (*stored, np.packbits(bits, axis=1))]
                    yield pa.RecordBatch.from_arrays([*(part.column(c) for c in ("k", "w", "vector")), *codes, lists], names=["k", "w", "vector", "signs", "factors", "bands", "keys"])

    return run


def _values(bits: np.ndarray, width: int) -> np.ndarray:
    """Each band's signs as a number."""
    return (bits.reshape(len(bits), -1, width) @ (1 << np.arange(width, dtype=np.uint64))).astype(np.uint64)


def _compare(threshold: float, width: int, kind: type):
    """Units of rows (unit, band, side, k, w, vector, signs, factors, bands) sorted by unit: counts of links, and a forest of them.

    Rows with side 0 alone are compared with each other; with sides 1 and 2, across. Returns (k, other, n): n links
    of k if other is null, else an edge of the forest.
    """

    def unit(rows: pa.Table, out: list) -> None:
        band, (side, k, w) = rows.column("band")[0].as_py(), (rows.column(c).to_numpy() for c in ("side", "k", "w"))
        across = side.max() > 0
        left, right = (np.flatnonzero(side == 1), np.flatnonzero(side == 2)) if across else (np.arange(len(k)), np.arange(len(k)))
        if not len(left) or not len(right):
            return
        x = _units(rows.column("vector").to_pylist(), kind)
        coder, words = Coder(x.shape[1]), -(-x.shape[1] // 64)
        of = lambda name, kind: np.frombuffer(b"".join(rows.column(name).to_pylist()), kind).reshape(len(k), len(coder.turns), -1).swapaxes(0, 1)[:, right]
        signs, factors = of("signs", np.uint64).reshape(len(coder.turns), len(right), words), of("factors", np.float32)[..., 0].astype(np.float64)
        first, second = [], []
        for a in range(0, len(left), 128):
            some = left[a : a + 128]
            i, j = coder.near(x[some], signs, factors, threshold)  # the others can't reach it
            i, j = some[i], right[j]
            if not across:
                i, j = i[i < j], j[i < j]
            for b in range(0, len(i), 20_000):
                p, q = i[b : b + 20_000], j[b : b + 20_000]
                ok = np.einsum("ij,ij->i", x[p], x[q]) >= threshold
                first.append(p[ok])
                second.append(q[ok])
        if not first:
            return
        i, j = np.concatenate(first), np.concatenate(second)
        if not len(i):
            return
        new = np.ones(len(i), bool)
        if band:
            packed = np.stack([np.frombuffer(b, np.uint8) for b in rows.column("bands").to_pylist()])
            values = _values(np.unpackbits(packed, axis=1, count=packed.shape[1] * 8 // width * width)[:, : band * width], width)
            for b in range(0, len(i), 20_000):
                new[b : b + 20_000] = ~(values[i[b : b + 20_000]] == values[j[b : b + 20_000]]).any(1)
        n = np.bincount(i[new], w[j[new]], len(k)) + np.bincount(j[new], w[i[new]], len(k))
        label = np.arange(len(k))
        while True:
            least = label.copy()
            low = np.minimum(label[i], label[j])
            np.minimum.at(least, i, low)
            np.minimum.at(least, j, low)
            least = least[least]
            if (least == label).all():
                break
            label = least
        for m in np.flatnonzero(n):
            out.append((int(k[m]), None, int(n[m])))
        for m in np.flatnonzero(label != np.arange(len(k))):
            out.append((int(k[m]), int(k[label[m]]), 0))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.schema([("k", pa.int64()), ("other", pa.int64()), ("n", pa.int64())])
        held: pa.Table | None = None

        def flush(rows: pa.Table, last: bool) -> tuple[list, pa.Table]:
            ids = rows.column("unit").to_numpy()
            starts = np.flatnonzero(np.r_[True, ids[1:] != ids[:-1]])
            ends = np.r_[starts[1:], len(ids)]
            out: list = []
            done = len(starts) if last else len(starts) - 1
            for a, b in zip(starts[:done].tolist(), ends[:done].tolist(), strict=True):
                if b - a > 1:
                    unit(rows.slice(a, b - a), out)
            return out, rows.slice(starts[-1]) if not last else rows.slice(0, 0)

        for whole in batches:
            for a in range(0, whole.num_rows, 4000):
                more = pa.Table.from_batches([whole.slice(a, 4000)])
                held = more if held is None or not held.num_rows else pa.concat_tables([held, more]).combine_chunks()
                out, held = flush(held, False)
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out, strict=True)], schema=kind)
        if held is not None and held.num_rows:
            out, _ = flush(held, True)
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out, strict=True)], schema=kind)

    return run


def link(vectors: DataFrame, threshold: float = 0.95, recall: float = RECALL, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(id, n_links, component_id) for each row of vectors."""
    kind = vectors.select(F.col(f"`{id_col}`").alias("id")).dtypes[0][1]
    base = cut(vectors.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{vector_col}`").alias("vector")).mapInArrow(_vectors, f"id {kind}, k long, vector binary"))
    classes = cut(base.where("k is not null").groupBy("k").agg(F.min("id").alias("rep"), F.count("*").alias("w"), F.first("vector").alias("vector")))
    width, n_bands = bands(classes.count(), threshold, recall)
    single = np.float32 if dict(vectors.dtypes)[vector_col] == "array<float>" else np.float64
    fields = "k long, w long, vector binary, signs binary, factors binary, bands binary"
    coded = cut(classes.select("k", "w", "vector").mapInArrow(_coded(width, n_bands, single), f"{fields}, keys array<long>"))
    own = ["k", "w", "vector", "signs", "factors", "bands"]
    rows = coded.select(*own, F.posexplode("keys").alias("band", "key"))
    buckets = cut(coded.select(F.explode("keys").alias("key")).groupBy("key").agg(F.count("*").alias("c")).where("c > 1"))
    found = rows.join(small(buckets, buckets.count()), "key").withColumn("blocks", F.ceil(F.col("c") / BLOCK).cast("int")).withColumn("block", F.pmod(F.xxhash64("k"), F.col("blocks")).cast("int"))
    found = found.withColumn("with", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    low, high = F.least("block", "with"), F.greatest("block", "with")
    side = F.when(F.col("block") == F.col("with"), 0).when(F.col("block") < F.col("with"), 1).otherwise(2)
    dealt = found.select(F.xxhash64("key", low, high).alias("unit"), "band", side.cast("int").alias("side"), *own).repartition("unit").sortWithinPartitions("unit")
    got = cut(dealt.mapInArrow(_compare(threshold, width, single), "k long, other long, n long"))
    counts = got.where("other is null").groupBy("k").agg(F.sum("n").alias("n"))
    labels = components(got.where("other is not null").select(F.col("k").alias("a"), F.col("other").alias("b")))
    named = classes.select("k", "rep", "w").join(labels.withColumnRenamed("node", "k"), "k", "left").withColumn("label", F.coalesce("component", "k"))
    least = named.groupBy("label").agg(F.min("rep").alias("component_id"))
    known = cut(named.join(least, "label").join(counts, "k", "left").select("k", "component_id", (F.coalesce("n", F.lit(0)) + F.col("w") - 1).alias("n_links")))
    out = base.select("id", "k").join(known, "k", "left")
    own = F.when(F.col("k").isNull(), F.col("id")).otherwise(F.col("component_id"))
    return out.select(F.col("id").alias(id_col), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), own.alias("component_id"))
