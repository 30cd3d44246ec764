"""The corpus pipeline: language, quality, near duplicates, mixture, tokens.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir) and returns a DataFrame, which ``run``
writes as Parquet and reads again for the next. All stages but the last return the columns of ``documents``.

A null or empty text leaves at the first stage (it has no language). Stages add no columns of their own, so extra
columns of the input pass through all stages but the last. An empty table passes through as empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandline.llm import bpe, language, mixing, near_dedup, quality
from strandline.llm._common import remainder, remove, scratch, table
from strandline.llm.queries import vocabulary

#: The share of a document that its main language must have.
MAIN_LANGUAGE = 0.5


#: Columns that stages look at.
READ = ("doc_id", "text", "lang", "source")


def _plain(docs: DataFrame) -> DataFrame:
    """docs with all columns that no stage looks at under names that no operator uses."""
    return docs.toDF(*[c if c in READ else f"column {i}" for i, c in enumerate(docs.columns)])


def _only(df: DataFrame, docs: DataFrame) -> DataFrame:
    """The columns of docs, by the names of ``_plain``, under their own."""
    return df.select(*[F.col(f"`{p}`").alias(c) for p, c in zip(_plain(docs).columns, docs.columns, strict=True)])


def by_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a known main language. Two thirds of the labelled documents train, as in op10."""
    model = language.fit(docs.where(remainder("doc_id", 3) != 1))
    found = language.predict(_plain(docs), model)
    return _only(found.where((F.col("_lang_pred") != language.UNKNOWN) & (F.col("_score") >= MAIN_LANGUAGE)), docs)


def by_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose posterior quality and base test hold."""
    return quality.keep(docs)


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each group that shares 80 % of its shingles of five words."""
    return near_dedup.keep_first(docs, width=5, percent=80)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources in their target weights; a document is in as often as the mix's shards drew it, shard by shard in shuffled order."""
    return _only(mixing.shuffled(mixing.mix(_plain(docs))), docs)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The ids of each document's tokens."""
    got = bpe.encode(docs, vocabulary())
    return got.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids")


STAGES = [("language", by_language), ("quality", by_quality), ("near_duplicates", without_copies), ("mixture", mixed), ("tokens", encoded)]

#: No SQL: expectation-maximisation, seeded permutations and BPE merges aren't SQL; each stage is tested against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, last = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        path = scratch(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if last:
            remove(spark, last)
        last = path
    return docs
