"""Language-model scores, languages, tokens, url decisions, archives and the pipeline."""

from __future__ import annotations

import gzip
import hashlib
import math
import random
import re
import tracemalloc
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from strandline.llm import bpe, language, lm, url_filter, warc_dedup
from strandline.llm.queries import QUERIES, RULES, vocabulary

WORD = re.compile("[^\x20\x09-\x0d]+")
ODD = [None, "", " \n", "A", "a  B\ta", "Ünï cödé", "x" * 50_000, "word " * 20_000, "a", "a", "\x00 null \x7f", "😀 😀 #1"]


def documents(spark, texts):
    rows = [(i, t, ("en", "de", None)[i % 3], f"s{i % 2}", "x", "y") for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, score string, ids string")


# --- language model


def counted(texts):
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return [[*WORD.findall((t or "").translate(low)), None] for t in texts]


@pytest.mark.parametrize("limits", [{}, {"max_filter": 0}])
def test_base_scores_equal_brute_force(spark, limits, monkeypatch):
    monkeypatch.setattr(lm, "GROUP", 2_000)
    rng = random.Random(4)
    texts = [*ODD, *[" ".join(f"w{int(rng.paretovariate(0.8)) % 500}" for _ in range(rng.randrange(80))) for _ in range(300)]]
    docs = documents(spark, texts)
    held = lambda i: zlib.crc32(str(i).encode()) % 7 == 2
    train = docs.where((F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7) != 2)
    got = {r.doc_id: r for r in lm.score(docs, train, **limits).collect()}
    tokens = counted(texts)
    c = Counter(w for i, t in enumerate(tokens) for w in t if not held(i))
    n, v = sum(c.values()), len(c)
    assert len(got) == len(texts)
    for i, t in enumerate(tokens):
        r = got[i]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(t), sum(c[w] > 0 for w in t), n)
        assert r.base_score == pytest.approx(sum(math.log10((c[w] + 1) / (n + v + 1)) for w in t), rel=1e-9)
        assert math.isfinite(r.score) and r.score < 0
    if limits:  # whichever of filters and probes travels
        whole = {r.doc_id: r.score for r in lm.score(docs, train).collect()}
        assert all(got[i].score == pytest.approx(whole[i], rel=1e-9) for i in whole)


def same_pair_keys():
    """Two words that share a pair's key after the word v."""
    words = np.array([f"w{i}" for i in range(300_000)])
    keys, _ = lm.word_hashes(np.frombuffer(" ".join(words).encode(), np.uint8), np.array([0, sum(map(len, words)) + len(words) - 1]))
    v, _ = lm.word_hashes(np.frombuffer(b"v", np.uint8), np.array([0, 1]))
    pairs = lm.pair_keys(np.full(len(keys), v[0]), keys)
    order = np.argsort(pairs)
    at = np.flatnonzero(pairs[order][1:] == pairs[order][:-1])[0]
    return words[order[at]], words[order[at + 1]]


@pytest.mark.parametrize("limits", [{}, {"max_filter": 0}])
def test_words_whose_pairs_share_a_key_keep_their_own_counts(spark, limits):
    one, two = same_pair_keys()
    texts = [f"v {one}", f"v {two}", *[f"{two} x"] * 9]
    got = {r.doc_id: r for r in lm.score(*[documents(spark, texts).coalesce(1)] * 2, **limits).collect()}
    c = Counter(w for t in counted(texts) for w in t)
    for i, t in enumerate(counted(texts)):
        assert got[i].base_score == pytest.approx(sum(math.log10((c[w] + 1) / (c.total() + len(c) + 1)) for w in t), rel=1e-9)


def test_rounds_of_probes_give_the_scores_of_the_broadcast_way(spark, sf, monkeypatch):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    whole = {r.doc_id: r for r in lm.score(docs, docs).collect()}
    for name, most in (("GROUP", 50_000), ("UNIT", 10_000), ("ROUND", 200_000)):
        monkeypatch.setattr(lm, name, most)
    got = lm.score(docs, docs, max_filter=0).collect()
    assert len(got) == len(whole)
    assert all(tuple(r)[:-2] == tuple(whole[r.doc_id])[:-2] and tuple(r)[-2:] == pytest.approx(tuple(whole[r.doc_id])[-2:], rel=1e-9) for r in got)


def test_a_key_is_looked_up_once_whoever_asks(monkeypatch):
    rng = np.random.default_rng(6)
    keys = np.unique(rng.integers(0, 1 << 63, 200).astype(np.uint64))
    counts = rng.integers(1, 1000, len(keys))
    shards = pa.table({"shard": [0], "bits": [lm.fill(keys, counts, lm.BASES[1]).tobytes()], "keys": [keys.tobytes()], "counts": [counts.tobytes()]})
    asked = [np.sort(rng.choice(keys, 50, replace=False)) for _ in range(100)]
    probes = pa.table({"src": pa.array(range(100)), "ord": [1] * 100, "unit": [0] * 100, "shard": [0] * 100, "keys": [k.tobytes() for k in asked]})
    looked, level = [], lm.Filter.level
    monkeypatch.setattr(lm.Filter, "level", lambda self, k: looked.append(len(k)) or level(self, k))
    got = lm._answers(1)(probes, shards)
    assert sum(looked) <= len(keys)
    for k, own, found in zip(asked, got.column("levels").to_pylist(), got.column("counts").to_pylist(), strict=True):
        assert (np.frombuffer(own, np.uint8) >= lm.levels(counts[np.searchsorted(keys, k)], lm.BASES[1])).all()
        assert (np.frombuffer(found, np.int64) == counts[np.searchsorted(keys, k)]).all()


def test_model_beats_the_base_on_held_out_text(spark, sf):
    got = QUERIES["op2_lm"](spark, sf).where("held_out").agg(F.sum("score"), F.sum("base_score")).first()
    assert got[0] > got[1]


@pytest.fixture(scope="module")
def corpus_of_pairs(spark):
    rng = random.Random(8)
    texts = [" ".join(f"w{int(rng.paretovariate(1.1)) % 60}" for _ in range(rng.randrange(1, 60))) for _ in range(400)]
    return texts, documents(spark, texts)


def test_scores_lie_near_those_of_exact_counts(spark, corpus_of_pairs):
    """By the formula of the module on plain counts; levels take at most a factor of both bases from each term."""
    texts, docs = corpus_of_pairs
    lists = counted(texts)
    one, two, first = Counter(w for t in lists for w in t), Counter(), Counter()
    for t in lists:
        for v, w in zip(["start", *t], t, strict=False):
            two[v, w] += 1
            first[v] += 1
    n, v_all = sum(one.values()), len(one)
    band = lambda c: min(int(lm.levels(np.array([c]), lm.BASES[1])[0]) // lm.BAND, lm.BANDS - 1)
    tokens_of, pairs_of = Counter(), Counter()
    for v, c in first.items():
        tokens_of[band(c)] += c
    for v, _ in two:
        pairs_of[band(first[v])] += 1
    m = {b: tokens_of[b] / (tokens_of[b] + pairs_of[b]) for b in tokens_of}
    got = {r.doc_id: r.score for r in lm.score(docs, docs).collect()}
    gaps, most = 0.0, math.log10(lm.BASES[1] * lm.BASES[2])
    for i, t in enumerate(lists):
        exact = 0.0
        for v, w in zip(["start", *t], t, strict=False):
            weight = m[band(first[v])]
            exact += math.log10(weight * two[v, w] / first[v] + (1 - weight) * (one[w] + 1) / (n + v_all + 1))
        assert abs(got[i] - exact) <= len(t) * most
        gaps += abs(got[i] - exact)
    assert gaps <= 0.5 * most * n


def test_probabilities_of_all_words_add_up_to_one_at_most(spark, corpus_of_pairs):
    texts, docs = corpus_of_pairs
    own = lm.Trained(docs)
    words = sorted({w for t in counted(texts) for w in t if w})
    data = " ".join(words).encode()
    keys, _ = lm.word_hashes(np.frombuffer(data, np.uint8), np.array([0, len(data)]))
    keys = np.append(keys, lm.END)
    lexicon, pairs = lm.Lexicon(own.model, own.filter(1).value, own.table().value), own.filter(2).value
    unknown = np.array([12345], np.uint64)
    for v in [*keys[:-1], lm.START]:
        token = np.append(keys, unknown)
        logs, _ = lm.terms(lexicon, pairs, np.full(len(token), v, np.uint64), token)
        by_mistake = lexicon.of(np.array([v], np.uint64))[2, 0] * len(keys) * 0.1  # a few of the pairs that don't occur
        assert 1 / (lm.BASES[1] * lm.BASES[2]) <= (10.0**logs).sum() <= 1 + by_mistake


def test_filter_reads_counts_back():
    rng = np.random.default_rng(5)
    keys = np.unique(rng.integers(0, 1 << 63, 20_000).astype(np.uint64))
    counts = np.maximum(1, rng.pareto(0.7, len(keys)) * 3).astype(np.int64)
    shards = {s: lm.fill(keys[(keys >> np.uint64(63)) == s], counts[(keys >> np.uint64(63)) == s], 1.2).tobytes() for s in (0, 1)}
    f = lm.Filter(1, 1.2, {s: len(b) for s, b in shards.items()}, shards.items())
    level = f.level(keys)
    assert (level >= lm.levels(counts, 1.2)).all() and (level == lm.levels(counts, 1.2)).mean() > 0.95
    assert (f.level(rng.integers(0, 1 << 63, 20_000).astype(np.uint64)) == 0).mean() > 0.95


def test_no_documents_to_score(spark):
    docs = documents(spark, ODD)
    assert lm.score(docs.limit(0), docs).collect() == []
    alone = lm.score(docs, docs.limit(0)).collect()
    assert len(alone) == len(ODD) and all(r.train_tokens == 0 and r.n_known == 0 and r.base_score == 0 for r in alone)


# --- languages


def test_languages_of_held_out_documents(spark, sf):
    got = QUERIES["op10_language"](spark, sf)
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text", "lang")
    both = got.join(docs, "doc_id").where("held_out and lang is not null and length(text) > 100")
    assert both.where("lang = lang_pred").count() >= 0.95 * both.count() > 0
    assert got.where("score < 0 or score > 1").count() == 0


def test_texts_without_letters_are_unknown(spark):
    docs = documents(spark, [*ODD, *["the quick brown fox jumps over the lazy dog again " * 3, "der schnelle braune fuchs springt über den faulen hund " * 3, "..."] * 10, "123 456", "---"])
    rows = language.predict(docs, language.fit(docs)).collect()
    assert len(rows) == docs.count()
    for r in rows:
        letters = r.text is not None and any(c.isalpha() for c in r.text)
        assert (r._lang_pred == "und") == (not letters), r.text
        assert (r._score == 0) == (r._lang_pred == "und")
    assert {r._lang_pred for r in language.predict(docs, language.fit(docs.limit(0))).collect()} == {"und"}
    assert language.predict(docs.limit(0), language.fit(docs)).collect() == []


def test_mixtures_are_found(spark):
    one, two = "the quick brown fox jumps over the lazy dog with all its friends ", "der schnelle braune fuchs springt über den faulen hund mit seinen freunden "
    docs = documents(spark, [x for _ in range(10) for x in (one * 5, two * 5, "")])
    model = language.fit(docs)
    mixed = language.predict(documents(spark, [one * 20 + two * 10]), model).first()
    assert set(mixed._langs) == {"en", "de"} and mixed._lang_pred == "en" and 0.5 < mixed._score < 0.85
    assert language.predict(documents(spark, [one * 20]), model).first()._langs == ["en"]


def test_short_texts_take_little_memory():
    model = language.Model(["a", "b"], np.ones((2, language.BUCKETS)))
    data, at = np.frombuffer(b"one short text, 18" * 10_000, np.uint8), np.arange(0, 180_001, 18)
    tracemalloc.start()
    found = model.mixture(data, at)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(found) == 10_000 and all(found) and most < 120 << 20


def test_a_fourth_language_is_found():
    rng = random.Random(2)
    letters = ["abcde", "fghij", "klmno", "pqrst", "uvwxy"]
    text = lambda i, n: " ".join("".join(rng.choice(letters[i]) for _ in range(5)) for _ in range(n)).encode()
    counts = np.zeros((5, language.BUCKETS))
    for i in range(5):
        own = np.frombuffer(text(i, 4000), np.uint8)
        counts[i] = np.bincount(language.trigrams(own, np.array([0, len(own)]))[1], minlength=language.BUCKETS)
    mixed = np.frombuffer(b" ".join(text(i, 300 + 50 * i) for i in range(4)), np.uint8)
    (found,) = language.Model(list("abcde"), counts).mixture(mixed, np.array([0, len(mixed)]))
    assert [name for name, _ in found] == ["d", "c", "b", "a"] and sum(s for _, s in found) == pytest.approx(1)


def test_languages_keep_columns_that_clash(spark):
    docs = documents(spark, ["the quick brown fox", None]).selectExpr("*", "1 as row", "2 as found", "3 as letter", "'mine' as _found", "4 as _score")
    got = language.predict(docs, language.fit(docs))
    assert got.columns == [c for c in docs.columns if c != "_score"] + ["_langs", "_shares", "_lang_pred", "_score"]
    assert {(r.row, r.found, r.letter, r._found) for r in got.collect()} == {(1, 2, 3, "mine")}


# --- tokens


def test_tokens_equal_the_library(spark, sf):
    from tokenizers import Tokenizer

    rng = random.Random(6)
    letters = "abcXYZ 019'\n\t.,!?-éßИдя中文😀́ <|>_"
    texts = [*ODD, "I'm we'll don't 'S", "<|endoftext|> x<|startoftext|>y", "<|endoftext", "İstanbul ǅ ﬁ", *["".join(rng.choice(letters) for _ in range(rng.randrange(60))) for _ in range(300)]]
    docs = documents(spark, texts).union(spark.read.parquet(f"{sf}/documents.parquet").select(F.col("doc_id") + 10_000, "text", "lang", "source", F.lit("x"), F.lit("y")))
    rows = {r.doc_id: r.text or "" for r in docs.collect()}
    own = Tokenizer.from_file(vocabulary())
    own.no_truncation()
    own.no_padding()
    want = {}
    for i, t in rows.items():
        ids = own.encode(t, add_special_tokens=False).ids
        text = own.decode(ids, skip_special_tokens=False)
        want[i] = (len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(text.encode()).hexdigest())
    got = {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in bpe.digests(docs, vocabulary()).collect()}
    assert {i: rows[i][:80] for i in want if got[i] != want[i]} == {}
    pairs = bpe.decode(bpe.encode(docs, vocabulary()), vocabulary()).collect()
    assert all(len(r.ids) == want[r.doc_id][0] and hashlib.sha256(r.text.encode()).hexdigest() == want[r.doc_id][2] for r in pairs)
    assert bpe.digests(docs.limit(0), vocabulary()).collect() == []


def test_forced_cuts_change_no_word_and_a_full_cache_no_result():
    small, large = bpe.Encoder(vocabulary(), cache=300), bpe.Encoder(vocabulary())
    for word in ("zqxjkv" * 20, "qqqqqqqq", "中文字", "hello"):
        assert small.encode(word) == large.encode(word)
    assert large.cuts("".join(large.letter[b] for b in "zqжx".encode()))


# --- urls


def brute_verdicts(rows):
    """Host, path, rule and own verdict by the rules alone."""
    out = {}
    for i, url, _ in rows:
        rest = url.split("://", 1)[1] if url and "://" in url else ""
        host, path = re.match("(?s)([^/?#]*)([^?#]*)", rest).groups()
        host = host.translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
        fits = [(len(h + p), h + p, v) for h, p, v in RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
        best = max(fits, default=(0, None, None))
        out[i] = (host, path, best[1], best[2])
    return out


def test_url_decisions(spark):
    link = '<link rel="canonical" href="{}">'
    rows = [
        (1, "https://A.Example.ORG/es/x", None),
        (2, "http://x.net/1", link.format("http://example.org/es/page")),
        (3, "http://example.org/es/page", ""),
        (4, "http://x.net/2", "<meta http-equiv='refresh' content='0; url=http://x.net/1'>"),
        (5, "http://other.com/fr/a", link.format("http://y.net/b")),
        (6, "http://y.net/b?utm_source=q#frag", link.format("http://c.com/de/1")),
        (7, "http://c.com/de/1", ""),
        (8, "no scheme", ""),
        (9, None, link.format("http://c.com/de/1")),
        (10, "http://example.org/en/12?x=://y", ""),
        (11, "http://z.net/", ""),
        (11, "http://z.net/", ""),
        (12, "ftp://host.org#f", ""),
    ]
    pages = spark.createDataFrame([(*r, "a", "b") for r in rows], "page_id long, url string, html string, host string, node string")
    got = {r.page_id: r for r in url_filter.judge(pages, RULES).collect()}
    own = brute_verdicts(rows)
    assert {i: (r.host, r.path, r.rule) for i, r in got.items()} == {i: x[:3] for i, x in own.items()}
    verdict = {i: x[3] or "allow" for i, x in own.items()} | {2: "block", 4: "block", 6: "allow"}
    assert {i: r.verdict for i, r in got.items()} == verdict
    assert url_filter.judge(pages, RULES).count() == len(rows) and url_filter.judge(pages.limit(0), RULES).collect() == []
    table = spark.createDataFrame([("http://z.net/", "http://c.com/de/1")], "source string, target string")
    assert {r.verdict for r in url_filter.judge(pages, RULES, table).where("page_id = 11").collect()} == {"allow"}  # an allow lies in the same component
    lone = spark.createDataFrame([("http://z.net/", "http://far.com/de/9")], "source string, target string")
    assert {r.verdict for r in url_filter.judge(pages, RULES, lone).where("page_id = 11").collect()} == {"block"}


def test_parameters_and_links_of_a_page(spark):
    pages = [
        (1, "http://a.net/p?pref=1", '<link rel="canonical" href="http://c.com/de/1">'),
        (2, "http://a.net/p?pref=2&utm_x=9", ""),
        (3, "http://a.net/p?x=1&ref=2", ""),
        (4, "http://a.net/p?ref=7&x=1", '<LINK href="../../de/./2?a=1&amp;b=2" rel=canonical>'),
        (5, "http://b.net/x/y/z", '<base href="http://c.com/o/"><link rel="canonical" href="http://b.net/q"><link rel=canonical href="../de/3">'),
        (6, "http://b.net/q", ""),
        (7, "http://c.com/fr/q", '<meta http-equiv="refresh" content="3;URL=/../../s">'),
        (8, "http://c.com/s", ""),
    ]
    frame = spark.createDataFrame(pages, "page_id long, url string, html string")
    rules = [("com", "/de/", "block"), ("com", "/fr/", "allow")]
    got = {r.page_id: r.verdict for r in url_filter.judge(frame, rules).collect()}
    assert got == {1: "block", 2: "allow", 3: "allow", 4: "allow", 5: "block", 6: "block", 7: "allow", 8: "allow"}
    table = spark.createDataFrame(rules, "host string, path string, verdict string")
    assert sorted(map(tuple, url_filter.judge(frame, table).collect())) == sorted(map(tuple, url_filter.judge(frame, rules).collect()))


def test_links_are_resolved_as_by_the_library(spark):
    from urllib.parse import urljoin

    links = ["../b", "./c", "../../../d/", "e/./f/../g?x=../y", "/h/../i", "?q", "//k.org/l/m", "http://m.org/n/", ".", "..", "g/", "a..b/c"]
    base = "http://s.org/x/y/z?w#v"
    df = spark.createDataFrame([(base, x) for x in links], "base string, link string")
    got = df.select("link", url_filter.resolved_path(url_filter.absolute(F.col("base"), F.col("link"))).alias("to")).collect()
    assert {r.link: r.to for r in got} == {x: urljoin(base, x) for x in links}


@pytest.mark.parametrize("seed", [1, 2])
def test_aliases_equal_brute_force(spark, seed):
    rng = random.Random(seed)
    url = lambda: f"http://{rng.choice(['a.com', 'b.org', 'x.example.org', 'n.net'])}/{rng.choice(['de', 'fr', 'es', 'q'])}/{rng.randrange(40)}"
    pages = []
    for i in range(200):
        links = [f'<link rel="canonical" href="{url()}">' for _ in range(rng.choice((0, 0, 1, 2)))] + [f"<meta http-equiv=refresh content='0;url={url()}'>" for _ in range(rng.choice((0, 0, 0, 1)))]
        pages.append((i, url(), "".join(links), [re.search("http:[^\"']+", x)[0] for x in links]))
    own = brute_verdicts([p[:3] for p in pages])
    near: dict = {}
    for _, u, _, to in pages:
        for v in to:
            near.setdefault(u, set()).add(v)
            near.setdefault(v, set()).add(u)
    explicit = {u: brute_verdicts([(0, u, "")])[0][3] for u in {*near, *(p[1] for p in pages)}}
    want = {}
    for i, u, _, _ in pages:
        seen, todo = {u}, [u]
        while todo:
            new = near.get(todo.pop(), set()) - seen
            seen |= new
            todo += new
        said = {explicit.get(x) for x in seen}
        want[i] = own[i][3] or ("allow" if "allow" in said else "block" if "block" in said else "allow")
    frame = spark.createDataFrame([p[:3] for p in pages], "page_id long, url string, html string")
    assert {r.page_id: r.verdict for r in url_filter.judge(frame, RULES).collect()} == want


# --- archives


def test_archives_round_trip(spark, tmp_path):
    long = "ü" * 80
    rows = [(5, "http://a/", long), (3, "http://b/", long), (9, None, long), (1, "http://c/", "short"), (2, "http://d/", "short"), (4, "http://e/", None), (6, "http://f/ x\n", ""), (7, "http://g/", "WARC/1.1\r\n\r\n\r\n\r\nContent-Length: 5\r\n\r\n" * 9), (8, "http://h/", "\r\n\r\n" * 50)]
    pages = spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, digest string")
    got = {r.page_id: r for r in warc_dedup.deduplicate(pages, str(tmp_path / "w")).collect()}
    assert set(got) == {r[0] for r in rows}
    for i, _, html in rows:
        body = (html or "").encode()
        r = got[i]
        assert (r.payload_bytes, r.payload_digest) == (len(body), hashlib.sha256(body).hexdigest())
        assert (r.record_type, r.refers_to) == (("revisit", 3) if i in (5, 9) else ("response", None))
    assert warc_dedup.deduplicate(pages.limit(0), str(tmp_path / "none")).collect() == []
    found = 0
    for part in (tmp_path / "w").glob("part-*"):  # any reader of gzip sees plain records, and each member is one
        whole = part.read_bytes()
        assert gzip.decompress(whole).count(b"\r\nWARC-Date: ") == sum(bool(gzip.decompress(m)) for m in whole.split(warc_dedup.EMPTY) if m)
        found += whole.count(warc_dedup.EMPTY)
    assert found == len(rows)


def test_archives_of_rows_that_repeat_or_lack_ids(spark, tmp_path, monkeypatch):
    long, other = "x" * 200, "y" * 150
    rows = [(None, "http://a/", long), (4, "http://b/", long), (4, "http://b/", long), (7, "http://c/", long), (7, "http://c/", other), (None, None, other), (None, "http://d/", "z" * 120), (None, "http://e/", "z" * 120)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    want = [(None, "revisit", 4), (4, "response", None), (4, "response", None), (7, "revisit", 4), (7, "response", None), (None, "revisit", 7), (None, "response", None), (None, "response", None)]
    for limit in (warc_dedup.SMALL, 0):
        monkeypatch.setattr(warc_dedup, "SMALL", limit)
        got = warc_dedup.deduplicate(pages, str(tmp_path / f"w{limit}")).collect()
        assert sorted((repr(r.page_id), r.record_type, repr(r.refers_to)) for r in got) == sorted((repr(a), b, repr(c)) for a, b, c in want)


# --- the whole


def test_pipeline(spark, sf):
    import corpus_pipeline

    docs = spark.read.parquet(f"{sf}/documents.parquet")
    before = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, before, sf)
        assert after.columns == docs.columns, name
        kept, ids = {r.doc_id for r in after.select("doc_id").collect()}, {r.doc_id for r in before.select("doc_id").collect()}
        assert kept <= ids and len(kept) >= 0.5 * len(ids), name
        before = after
    out = corpus_pipeline.STAGES[-1][1](spark, before, sf)
    assert out.count() == before.count() and out.where("n_tokens != size(ids)").count() == 0


def test_registered(spark):
    import __spark_entry__

    names = __spark_entry__.queries()
    assert set(QUERIES) <= set(names) and "pipeline" in names
    assert sorted(int(re.match(r"op(\d+)_", n)[1]) for n in QUERIES) == list(range(1, 11))
