"""Near-duplicate documents and embeddings, and components, against brute force."""

from __future__ import annotations

import math
import random
import re

import numpy as np
import pytest

from strandline.llm import embedding_dedup, near_dedup
from strandline.llm._components import components

WORD = re.compile("[^\x20\x09-\x0d]+")


def roots(n: int, links) -> list[int]:
    up = list(range(n))

    def find(x):
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        up[max(a, b)] = min(a, b)
    return [find(x) for x in range(n)]


def sets(text, width):
    low = (text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
    words = WORD.findall(low)
    if not words:
        return frozenset()
    return frozenset([tuple(words)]) if len(words) < width else frozenset(tuple(words[i : i + width]) for i in range(len(words) - width + 1))


def expected(rows, width):
    """(id, set size, smallest id of the component) by comparing all pairs."""
    own = [sets(t, width) for _, t in rows]
    links = [(i, j) for i in range(len(rows)) for j in range(i) if own[i] and own[j] and 100 * len(own[i] & own[j]) >= 80 * len(own[i] | own[j])]
    root = roots(len(rows), links)
    least = {}
    for (d, _), r in zip(rows, root, strict=True):
        least[r] = min([x for x in (least.get(r), d) if x is not None], default=None)
    return sorted(((d, len(s), least[r]) for (d, _), s, r in zip(rows, own, root, strict=True)), key=repr)


def corpus(seed=3):
    rng = random.Random(seed)
    word = lambda: f"{rng.choice('abcdefgh')}{rng.randrange(300)}"
    texts = [None, "", "  \n", "One", "ONE", "one two", "One\tTWO", "É e", "é e", "word " * 5000, "word " * 4000 + "end"]
    for _ in range(60):
        base = [word() for _ in range(rng.choice((5, 20, 60, 300)))]
        texts.append(" ".join(base))
        for _ in range(rng.randrange(4)):
            copy = list(base)
            for _ in range(rng.randrange(1 + len(base) // 12)):
                copy[rng.randrange(len(copy))] = word()
            texts.append(" ".join(copy))
    base = [word() for _ in range(200)]  # one large group of near copies
    for i in range(120):
        texts.append(" ".join([*base[: i % 9], f"n{i}", *base[i % 9 + 1 :]]))
    texts += [" ".join(base)] * 150
    rng.shuffle(texts)
    return list(enumerate(texts))


@pytest.mark.parametrize("width", [2, 5])
def test_documents_equal_brute_force(spark, width):
    rows = corpus()
    docs = spark.createDataFrame([(d, t, "x", 1) for d, t in rows], "doc_id long, text string, k string, n int").repartition(5)
    got = sorted([tuple(r) for r in near_dedup.deduplicate(docs, width=width).collect()], key=repr)
    assert got == expected(rows, width)


def test_a_group_of_two_thousand_keeps_its_links(spark):
    """Copies that are linked with few of the others: nodes stay large at every depth."""
    rng = np.random.default_rng(11)
    base, texts = [f"b{i}" for i in range(60)], []
    for i in range(2000):
        own = list(base)
        for place in rng.choice(60, rng.integers(1, 6), replace=False):
            own[place] = f"x{i}y{place}"
        texts.append(" ".join(own))
    number: dict = {}
    rows = [[number.setdefault(t, len(number)) for t in sets(text, 2)] for text in texts]
    has = np.zeros((2000, len(number)), np.float32)
    for i, own in enumerate(rows):
        has[i, own] = 1
    both, n = has @ has.T, has.sum(1)
    i, j = np.nonzero(np.triu(100 * both >= 80 * (n[:, None] + n[None, :] - both), 1))
    root = np.array(roots(2000, zip(i.tolist(), j.tolist(), strict=True)))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in near_dedup.deduplicate(docs, width=2).collect()}
    own = np.array([got[k] for k in range(2000)])
    assert (root[own] == root).all()  # nothing is linked that shouldn't be
    assert (own[i] == own[j]).mean() >= 0.999 and 1 < len(set(root.tolist())) < 2000


def test_columns_that_clash_stay(spark):
    rows = [(1, "a b c d e f g", 5), (2, "a b c d e f g", 6), (None, "a b c d e f g", 7), (None, "a b c d e f g", 8), (None, None, 9), (3, "", 1)]
    docs = spark.createDataFrame([(*r, *"uvwxyz") for r in rows], "doc_id long, text string, _rows int, h string, k string, row string, later string, first string, rows string")
    kept = near_dedup.keep_first(docs)
    assert kept.columns == docs.columns
    assert sorted((r._rows, r.h, r.rows) for r in kept.collect()) == [(1, "u", "z"), (5, "u", "z"), (9, "u", "z")]
    alone = docs.where("doc_id is null and text is not null")
    assert near_dedup.keep_first(alone).count() == 1


def test_documents_without_ids_and_rows_that_repeat(spark):
    rows = [(None, "a b c d e f"), (7, "a b c d e f"), (7, "a b c d e f"), (7, "other words here"), (9, None), (9, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted([tuple(r) for r in near_dedup.deduplicate(docs, width=2).collect()], key=repr) == expected(rows, 2)
    kept = near_dedup.keep_first(docs, width=2).collect()
    assert sorted([tuple(r) for r in kept], key=repr) == sorted([(7, "a b c d e f"), (7, "other words here"), (9, None)], key=repr)


def test_no_documents(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert near_dedup.deduplicate(docs).collect() == [] and near_dedup.keep_first(docs).collect() == []


def test_first_of_each_group_stays_whole(spark):
    rows = [(d, t) for d, t in corpus(5) if t]
    docs = spark.createDataFrame([(d, t, d * 2) for d, t in rows], "doc_id long, text string, extra long")
    want = {d for d, _, c in expected(rows, 5) if d == c}
    kept = near_dedup.keep_first(docs).collect()
    assert {r.doc_id for r in kept} == want and len(kept) == len(want)
    assert all(r.extra == 2 * r.doc_id and r.text == dict(rows)[r.doc_id] for r in kept)


@pytest.mark.parametrize("each", [1_000_000, 50])
def test_components(spark, each):
    rng = random.Random(each)
    links = [(rng.randrange(400), rng.randrange(400)) for _ in range(280)] + [(i, i + 1) for i in range(500, 560)] + [(3, 3), (1, 2), (2, 1)] + [(600, i) for i in range(601, 700)]
    got = {r.node: r.component for r in components(spark.createDataFrame([*links, (None, 5)], "a long, b long"), each).collect()}
    root = roots(700, links)
    assert got == {x: root[x] for e in links if e[0] != e[1] for x in e}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def vectors(seed=2, dim=32):
    rng = np.random.default_rng(seed)
    out = []
    for _ in range(40):
        centre = rng.standard_normal(dim)
        for _ in range(int(rng.integers(1, 8))):
            out.append((centre + rng.standard_normal(dim) * rng.choice([0.02, 0.1, 0.2])).tolist())
    common = rng.standard_normal(dim)
    out += [(common + rng.standard_normal(dim) * 0.05).tolist() for _ in range(60)]
    out += [common.tolist()] * 30 + [(2 * common).tolist()]
    tiny, huge = (common * 1e-200).tolist(), (common * 1e200).tolist()  # their squares aren't doubles
    return out + [tiny, huge, None, [0.0] * dim, [float("nan")] * dim, [float("inf")] + [1.0] * (dim - 1), [None] + [1.0] * (dim - 1), [], [1.0, 0.0]]


def test_embeddings_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(embedding_dedup, "BLOCK", 16)  # so that buckets are dealt in blocks
    xs = vectors()
    frame = spark.createDataFrame([(i, x, 0) for i, x in enumerate(xs)], "vec_id long, embedding array<double>, k int").repartition(5)
    got = {r.vec_id: (r.n_links, r.component_id) for r in embedding_dedup.link(frame, recall=1 - 1e-9).collect()}
    unit = []
    for x in xs:
        a = np.array([np.nan if v is None else v for v in x]) if x is not None else np.zeros(0)
        a = a / np.abs(a).max() if len(a) and np.isfinite(a).all() and a.any() else None
        unit.append(a / np.linalg.norm(a) if a is not None else None)
    links = [(i, j) for i in range(len(xs)) for j in range(i) if unit[i] is not None and unit[j] is not None and len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= 0.95]
    n = np.bincount(np.array(links).ravel(), minlength=len(xs))
    root = roots(len(xs), links)
    assert got == {i: (int(n[i]), root[i]) for i in range(len(xs))}


def test_embeddings_of_the_table_keep_their_links(spark, sf):
    table = spark.read.parquet(f"{sf}/embeddings.parquet")
    rows = table.collect()
    x = np.array([r.embedding for r in rows], float)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    n = ((x @ x.T) >= 0.95).sum(1) - 1
    got = {r.vec_id: r.n_links for r in embedding_dedup.link(table).collect()}
    want = {r.vec_id: int(m) for r, m in zip(rows, n, strict=True)}
    assert sum(got.values()) >= 0.999 * sum(want.values()) and all(got[k] <= want[k] for k in got)


def test_recall_of_embeddings_at_the_threshold(spark):
    """3,000 vectors in pairs and groups around a cosine of 0.95, at the default recall."""
    rng = np.random.default_rng(4)
    rows = []
    for _ in range(600):
        centre = rng.standard_normal(48)
        centre /= np.linalg.norm(centre)
        for _ in range(5):
            side = rng.standard_normal(48)
            side -= (side @ centre) * centre
            angle = math.acos(0.95) * rng.uniform(0.3, 0.8)
            rows.append((np.cos(angle) * centre + np.sin(angle) * side / np.linalg.norm(side)).astype(np.float32).tolist())
    x = np.array(rows, np.float32).astype(float)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    n = ((x @ x.T) >= 0.95).sum(1) - 1
    got = {r.vec_id: r.n_links for r in embedding_dedup.link(spark.createDataFrame(list(enumerate(rows)), "vec_id long, embedding array<float>")).collect()}
    assert all(got[k] <= n[k] for k in got) and sum(got.values()) >= 0.99 * n.sum() > 1000


def test_estimates_are_unbiased_and_bounded():
    rng = np.random.default_rng(8)
    x = rng.standard_normal((300, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    coder = embedding_dedup.Coder(64)
    est, half = coder.estimate(x[:50], *coder.encode(x))
    error = est - x[:50] @ x.T
    assert abs(error.mean()) < 0.01 and (np.abs(error) <= half).mean() > 0.999


def test_no_embeddings(spark):
    assert embedding_dedup.link(spark.createDataFrame([], "vec_id long, embedding array<float>")).collect() == []
