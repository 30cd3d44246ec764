"""Sharding, mixing and quality rules against plain Python."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from strandline.llm import mixing, quality, sharding

WORD = re.compile("[^\x20\x09-\x0d]+")
TEXTS = [None, "", " \t\n", "one", "ä ö ü", "same text again", "same text again", "a b c d e a b c d e", "x\ny\nx\n \nx", "#tag $5 50% <b>", "long " * 3000, "  lead and trail \r\n"]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, _size string, shard string, h string"


def frame(spark, rows):
    """documents with extra columns whose names clash with the operators' own."""
    return spark.createDataFrame([(i, t, "en", s, None if t is None else len(t), "x", "y", "z") for i, t, s in rows], SCHEMA)


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, f"s{i % 3}" if i % 4 else None) for i, t in enumerate(TEXTS)]
    return frame(spark, [*rows, (3, "one", "s0"), (None, "no id", "s1"), *[(100 + i, f"word {i} " * (i % 7 + 1), "hot") for i in range(60)]])


def crc(text):
    return zlib.crc32((text or "").encode())


def test_shards_are_contiguous_whole_and_even(spark, docs):
    got = sharding.assign(docs, n_shards=5).collect()
    want = Counter((r.doc_id, len((r.text or "").encode()) + 16, crc(r.text)) for r in docs.collect())
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in got) == want
    total, order = sum(r.size for r in got), sorted(got, key=lambda r: (r.shard, r.slot))
    for s in range(5):
        slots = [r.slot for r in order if r.shard == s]
        assert slots == list(range(len(slots)))
    ids = [r.doc_id if r.doc_id is not None else -1 for r in order]
    assert ids == sorted(ids)
    end = 0
    for r in order:  # midpoints decide
        end += r.size
        assert r.shard == min(4, (2 * end - r.size) * 5 // (2 * total))


def test_no_rows_no_shards(spark, docs):
    assert sharding.assign(docs.limit(0)).collect() == []


def test_written_shards_hold_every_column(spark, tmp_path):
    docs = spark.createDataFrame([(i, f"text {i}", i * 2) for i in range(50)], "doc_id long, text string, extra int")
    sharding.write_shards(docs, str(tmp_path / "s"), n_shards=3)
    back = spark.read.parquet(str(tmp_path / "s"))
    assert sorted((r.doc_id, r.text, r.extra) for r in back.collect()) == [(i, f"text {i}", i * 2) for i in range(50)]


def targets(sizes: dict, cap: int = 3) -> dict:
    """Targets by sharing the excess again and again."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode("utf-32-be")) + ([None] if None in sizes else [])
    weight = {s: (1, 2, 3)[i % 3] for i, s in enumerate(names)}
    left, live, out = sum(sizes.values()), set(names), {}
    while live:
        level = left / sum(weight[s] for s in live)
        over = {s for s in live if level * weight[s] > cap * sizes[s]}
        if not over:
            return out | {s: level * weight[s] for s in live}
        for s in over:
            out[s] = float(cap * sizes[s])
            left -= out[s]
        live -= over
    return out


def test_mix_reaches_its_targets(spark, docs):
    got = mixing.plan(docs).collect()
    sizes = Counter()
    for r in docs.collect():
        sizes[r.source] += len(WORD.findall(r.text or ""))
    want = targets(sizes)
    assert Counter((r.doc_id, r.size) for r in got) == Counter((r.doc_id, len(WORD.findall(r.text or ""))) for r in docs.collect())
    for s, size in sizes.items():
        own = [r for r in got if r.source == s]
        assert all(r.source_size == size and r.target == pytest.approx(want[s]) for r in own)
        assert abs(sum(r.taken for r in own) - want[s]) <= max(r.size for r in own)
        assert all(0 <= r.taken <= 3 * r.size for r in own)


def test_mix_is_the_same_again_and_agrees_with_its_plan(spark, docs):
    plan = mixing.plan(docs)
    key = lambda r: (r.doc_id, r.source, r.size, r.taken, tuple(sorted(zip(r.shards, r.places, strict=True))))
    assert Counter(map(key, plan.collect())) == Counter(map(key, mixing.plan(docs.repartition(7)).collect()))
    rows = mixing.mix(docs, levels=2)
    copies = Counter()
    for r in mixing.plan(docs, levels=2).collect():
        assert len(r.shards) == r.copies and r.taken == r.copies * r.size
        for s, p in zip(r.shards, r.places, strict=True):
            copies[r.doc_id, s, p] += 1
    assert Counter((r.doc_id, r._shard, r._place) for r in rows.collect()) == copies
    assert rows.columns == [*docs.columns, "_shard", "_place"] and {r._shard for r in rows.collect()} <= set(range(4))


def test_rows_without_ids_are_drawn_one_by_one(spark):
    rows = [(None, f"three words {i}", f"s{i % 3}") for i in range(150)] + [(None, "the same row", "s0")] * 60 + [(7, "the same id", "s1")] * 40
    docs = frame(spark, rows).selectExpr("*", "1 as _shard", "'h' as row", "5 as drawn")
    got = mixing.plan(docs).collect()
    sizes = Counter()
    for _, t, s in rows:
        sizes[s] += 3
    want = targets(sizes)
    for s in sizes:
        assert abs(sum(r.taken for r in got if r.source == s) - want[s]) <= 3
    mixed = mixing.mix(docs)
    assert mixed.columns == [c for c in docs.columns if c != "_shard"] + ["_shard", "_place"]
    assert mixed.count() == sum(r.copies for r in got) and {r.row for r in mixed.collect()} == {"h"}
    order = [(r._shard, r._place) for r in mixing.shuffled(mixed).collect()]
    assert order == sorted(order)


def test_splitting_tree_keeps_quotas_and_halves_nodes(spark):
    quota = spark.createDataFrame([("a", 1, 99, None), ("b", 0, 31, None), (None, 2, None, None)], "source string, passes int, edge int, last long")
    drawn = mixing.tree(quota, 3, 5).collect()
    by = Counter(r.source for r in drawn)
    assert by == {"a": 256 + 100, "b": 32, None: 512} and len({(r.source, r["pass"], r.block) for r in drawn}) == len(drawn)
    per = Counter(r.shard for r in drawn)
    assert set(per) == set(range(8)) and max(per.values()) - min(per.values()) <= 3


def test_empty_mix(spark, docs):
    assert mixing.plan(docs.limit(0)).collect() == [] and mixing.mix(docs.limit(0)).collect() == []
    bare = frame(spark, [(1, None, "a"), (2, " ", None)])
    assert [(r.size, r.target, r.taken) for r in mixing.plan(bare).collect()] == [(0, 0.0, 0)] * 2


def brute(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    often = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if often[w] > 1 for k in range(5)}
    chars = "".join(words)
    return len(words), len(chars), sum(c in "#*$%&|<>" for c in chars), len(lines) - len(set(lines)), len(covered)


def test_quality_figures(spark, docs):
    more = docs.union(frame(spark, [(900, "a b c d e f g h i j " * 4 + "tail", "s"), (901, "w " * 6, "s"), (902, "  nb sp   em", "s"), (903, "😀 #1\n😀 #1\n", "s")]))
    got = quality.report(more).collect()
    texts = {}
    for r in more.collect():
        texts.setdefault(r.doc_id, []).append(brute(r.text))
    assert len(got) == more.count()
    for r in got:
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) in texts[r.doc_id]
        assert r.base_failed == (r.n_words < 10 or 100 * r.n_repeat_words > 20 * r.n_words)
        assert not (r.base_failed and r.kept) and 0 <= r.probability <= 1


def test_quality_keeps_clean_and_drops_bad(spark):
    words = [f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(400)]
    good = [" ".join(words[(i * 7 + k * 13) % 400] for k in range(60 + i % 40)) for i in range(80)]
    bad = ["$$$ ### &&& ||| <<>> %% " * 5 + str(i) for i in range(8)] + [("buy now " * 40) + str(i) for i in range(8)]
    docs = frame(spark, [(i, t, "s") for i, t in enumerate(good + bad)])
    kept = {r.doc_id for r in quality.keep(docs).collect()}
    assert kept == set(range(80))
    assert {r.doc_id for r in quality.report(docs).where(F.col("kept")).collect()} == kept
    assert quality.keep(docs).columns == docs.columns


def test_votes_are_weighed_as_by_plain_code(spark):
    """EM over documents one by one, from votes drawn at random, and the shared model's verdicts on them."""
    rng, rows = random.Random(9), []
    for _ in range(600):
        good = rng.random() < 0.8
        rows.append([0 if rng.random() < 0.2 else (-1 if rng.random() < ((0.03 if good else 0.6) if j else 0.3) else 1) for j in range(quality.N_RULES)])
    prior, bad = 0.9, {y: [quality.START[y]] * quality.N_RULES for y in (0, 1)}
    for _ in range(100):
        p = []
        for votes in rows:
            like = {1: prior, 0: 1 - prior}
            for j, v in enumerate(votes):
                for y in like:
                    like[y] *= {-1: bad[y][j], 1: 1 - bad[y][j], 0: 1}[v]
            p.append(like[1] / (like[1] + like[0]))
        last = bad
        prior, bad = (sum(p) + 9) / (len(rows) + 10), {}
        for y in (0, 1):
            bad[y] = []
            for j in range(quality.N_RULES):
                weight = lambda v, y=y, j=j: sum((q if y else 1 - q) for q, votes in zip(p, rows, strict=True) if votes[j] == v)
                wrong, every = weight(-1), weight(-1) + weight(1)
                bad[y].append((wrong + quality.PRESUMED[y] * (0.5 * every + 1)) / (1.5 * every + 1))
        if max(abs(a - b) for y in (0, 1) for a, b in zip(bad[y], last[y], strict=True)) < 1e-4:
            break
    codes = spark.createDataFrame([(sum((v + 1) * 3**j for j, v in enumerate(votes)),) for votes in rows], "code int")
    model = quality.fit(codes)
    assert model[0] == pytest.approx(prior) and all(model[1][y] == pytest.approx(bad[y]) for y in (0, 1))
    got = [r.p for r in codes.select(quality._posterior(F.col("code"), (prior, bad)).alias("p")).collect()]
    assert [g >= 0.5 for g in got] == [q >= 0.5 for q in p]
    assert any(g >= 0.5 and -1 in votes for g, votes in zip(got, rows, strict=True)) and bad[1][0] > 3 * max(bad[1][1:])


def test_quality_agrees_with_the_labels_and_outvotes_single_rules(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    got = quality.report(docs).join(labels, "doc_id", "left").collect()
    told = [r for r in got if r.quality is not None and not r.base_failed]
    assert all(r.kept for r in told if r.quality == 1) and sum(not r.kept for r in told if r.quality == 0) >= 0.9 * sum(r.quality == 0 for r in told)
    votes = docs.select("doc_id", quality._let(quality.figures(F.col("text")), quality.pattern).alias("code")).collect()
    bad = {r.doc_id for r in votes if any(r.code // 3**j % 3 == 0 for j in range(quality.N_RULES))}
    assert sum(r.kept and r.doc_id in bad for r in got) >= 5
    assert {r.doc_id for r in got if r.kept} == {r.doc_id for r in quality.keep(docs).collect()}


def test_quality_of_nothing(spark, docs):
    assert quality.report(docs.limit(0)).collect() == [] and quality.keep(docs.limit(0)).collect() == []
