"""The registered queries as they are: against their SQL, or by what their contract fixes."""

from __future__ import annotations

import hashlib
import os
import re
import zlib
from collections import Counter

import duckdb
import pytest

import __spark_entry__
from strandline.llm.queries import ORACLE_SQL, QUERIES, vocabulary

WORD = re.compile("[^\x20\x09-\x0d]+")


def rows_of(spark, sf, table):
    return spark.read.parquet(f"{sf}/{table}.parquet").collect()


def held(i, of, at):
    return zlib.crc32(str(i).encode()) % of == at


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_equals_sql(spark, name):
    folder = "/root/testdata/sf0.01"
    con = duckdb.connect()
    for f in os.listdir(folder):
        con.execute(f"CREATE VIEW {f.split('.')[0]} AS SELECT * FROM read_parquet('{folder}/{f}')")
    result = con.execute(ORACLE_SQL[name])
    columns = sorted(d[0] for d in result.description)
    at = [[d[0] for d in result.description].index(c) for c in columns]
    want = Counter(tuple(r[i] for i in at) for r in result.fetchall())
    got = __spark_entry__.queries()[name](spark, folder)
    assert sorted(got.columns) == columns
    assert Counter(tuple(r[c] for c in columns) for r in got.collect()) == want


def test_scores(spark, sf):
    docs = {r.doc_id: r.text for r in rows_of(spark, sf, "documents")}
    got = QUERIES["op2_lm"](spark, sf).collect()
    assert {r.doc_id for r in got} == set(docs) and len(got) == len(docs)
    assert all(r.held_out == held(r.doc_id, 7, 2) and r.n_tokens == len(WORD.findall(docs[r.doc_id] or "")) + 1 for r in got)
    assert len({r.train_tokens for r in got}) == 1 and got[0].train_tokens == sum(r.n_tokens for r in got if not r.held_out)
    assert all(r.n_known == r.n_tokens for r in got if not r.held_out)


def test_mixture(spark, sf):
    docs = {r.doc_id: r for r in rows_of(spark, sf, "documents")}
    got = QUERIES["op5_mixing"](spark, sf).collect()
    size = Counter()
    for r in docs.values():
        size[r.source] += len(WORD.findall(r.text or ""))
    taken, target = Counter(), {}
    for r in got:
        own = docs[r.doc_id]
        assert r.size == len(WORD.findall(own.text or "")) and r.source_size == size[own.source] and 0 <= r.taken <= 3 * r.size
        assert r.taken == r.size * len(r.shards) and len(r.places) == len(r.shards)
        taken[own.source] += r.taken
        target[own.source] = r.target
    assert len(got) == len(docs) and sum(target.values()) == pytest.approx(sum(size.values()))
    assert all(abs(taken[s] - target[s]) <= max(r.size for r in got if docs[r.doc_id].source == s) for s in size)


def test_quality(spark, sf):
    from tests.llm.test_native import brute

    docs = {r.doc_id: r.text for r in rows_of(spark, sf, "documents")}
    got = QUERIES["op7_quality"](spark, sf).collect()
    assert len(got) == len(docs)
    for r in got:
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == brute(docs[r.doc_id])
        assert r.base_failed == (r.n_words < 10 or 100 * r.n_repeat_words > 20 * r.n_words) and not (r.kept and r.base_failed)
        assert r.kept == (not r.base_failed and r.probability >= 0.5)


def test_tokens(spark, sf):
    from tokenizers import Tokenizer

    own = Tokenizer.from_file(vocabulary())
    own.no_truncation()
    own.no_padding()
    docs = {r.doc_id: r.text for r in rows_of(spark, sf, "documents")}
    for r in QUERIES["op9_bpe"](spark, sf).collect():
        ids = own.encode(docs.pop(r.doc_id) or "", add_special_tokens=False).ids
        text = own.decode(ids, skip_special_tokens=False)
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(text.encode()).hexdigest())
    assert not docs


def test_languages(spark, sf):
    docs = {r.doc_id: r for r in rows_of(spark, sf, "documents")}
    learnt = {r.lang for r in docs.values() if r.lang is not None and not held(r.doc_id, 3, 1)}
    got = QUERIES["op10_language"](spark, sf).collect()
    assert len(got) == len(docs)
    for r in got:
        letters = any(c.isalpha() for c in docs[r.doc_id].text or "")
        assert r.held_out == held(r.doc_id, 3, 1) and 0 <= r.score <= 1
        assert r.lang_pred in learnt if letters else r.lang_pred == "und"
