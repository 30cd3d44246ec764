"""Nulls, repeats, ties, empty tables and extra columns in every operator and stage."""

from __future__ import annotations

from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from strandline.llm import bpe, embedding_dedup, language, lm, quality, sharding, url_filter
from strandline.llm.queries import RULES, vocabulary

LONG = "the quick brown fox jumps over the lazy dog while many other animals look on and wonder what it is that makes it run so far today "
ROWS = [(None, LONG, "en", "s0"), (None, LONG, "en", "s0"), (None, None, None, None), (1, "", "en", "s0"), (2, LONG + "again", None, None), (2, LONG + "again", None, None), (3, "a b", "en", "s1"), (4, "ünï " * 40_000, "de", "s1")]
EXTRA = ["h", "k", "row", "rows", "drawn", "found", "letter", "v", "_rows", "_shard", "_place", "_h", "_lang_pred", "size", "first", "part"]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(*r, None if r[1] is None else len(r[1]), *(f"x{i}" for i in range(len(EXTRA)))) for r in ROWS]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{c}` string" for c in EXTRA))


@pytest.mark.parametrize("stage", range(len(corpus_pipeline.STAGES)))
def test_stages(spark, docs, stage):
    name, run = corpus_pipeline.STAGES[stage]
    assert run(spark, docs.limit(0), "").collect() == []
    got = run(spark, docs, "")
    rows = got.collect()
    if stage < len(corpus_pipeline.STAGES) - 1:
        assert got.columns == docs.columns and Counter((r.doc_id, r.text) for r in rows).keys() <= {(r[0], r[1]) for r in ROWS}
        assert all([r[c] for c in EXTRA] == [f"x{i}" for i in range(len(EXTRA))] for r in rows)
    else:
        assert len(rows) == len(ROWS)
    if name == "near_duplicates":  # rows without an id give way to row 2, but for the one without words
        assert Counter(r.doc_id for r in rows) == {2: 1, None: 1, 1: 1, 3: 1, 4: 1}


def test_repeated_rows_and_null_ids_stay_in_results(docs):
    ids = Counter(r[0] for r in ROWS)
    of = lambda df: Counter(r.doc_id for r in df.collect())
    assert of(lm.score(docs, docs)) == ids and of(bpe.digests(docs, vocabulary())) == ids and of(sharding.assign(docs, 3)) == ids and of(quality.report(docs)) == ids
    model = language.fit(docs)
    rows = language.predict(docs, model).collect()
    assert Counter(r.doc_id for r in rows) == ids and len({(r._lang_pred, r._score) for r in rows if r.text == LONG}) == 1


def test_a_tie_of_posterior_and_threshold_keeps(spark):
    docs = spark.createDataFrame([(1, LONG), (2, "### " * 30)], "doc_id long, text string")
    p = {r.doc_id: r.probability for r in quality.report(docs).collect()}
    got = {r.doc_id: (r.kept, r.base_failed) for r in quality.report(docs, threshold=p[1]).collect()}
    assert got[1] == (True, False) and got[2][1]


def test_vectors_that_repeat_ids(spark):
    rows = [(1, [1.0, 0.0]), (1, [0.0, 1.0]), (2, [1.0, 0.0]), (None, [0.0, 1.0]), (None, None)]
    got = Counter((r.vec_id, r.n_links, r.component_id) for r in embedding_dedup.link(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect())
    assert got == {(1, 1, 1): 2, (2, 1, 1): 1, (None, 1, 1): 1, (None, 0, None): 1}


def test_pages_that_repeat(spark):
    link = '<link rel="canonical" href="http://c.com/de/1">'
    rows = [(1, "http://a.net/", link), (1, "http://a.net/", link), (None, "http://a.net/#x", None), (2, None, link), (2, "x://", link)]
    got = Counter((r.page_id, r.verdict) for r in url_filter.judge(spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("node", F.lit(1)), RULES).collect())
    assert got == {(1, "block"): 2, (None, "block"): 1, (2, "allow"): 1, (2, "block"): 1}
