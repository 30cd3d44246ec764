"""The registered queries op1 to op10 and the SQL of those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandline.llm import bpe, embedding_dedup, language, lm, mixing, near_dedup, quality, sharding, url_filter, warc_dedup
from strandline.llm._common import remainder, table

RULES = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"), ("com", "/fr/", "allow"), ("com", "/de/", "block")]


def vocabulary() -> str:
    """Where the tokenizer's file is on this machine and, by the same import, on every worker."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op1_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = near_dedup.deduplicate(table(spark, sf_dir, "documents"), width=2, percent=80)
    return got.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def op2_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held = remainder("doc_id", 7) == 2
    got = lm.score(docs, docs.where(~held))
    return got.select("doc_id", held.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = warc_dedup.deduplicate(table(spark, sf_dir, "pages"))
    return got.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.assign(table(spark, sf_dir, "documents"), n_shards=40)
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.plan(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken", "copies", "shards", "places")


def op6_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = embedding_dedup.link(table(spark, sf_dir, "embeddings"), threshold=0.95)
    return got.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = quality.report(table(spark, sf_dir, "documents"))
    return got.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "probability")


def op8_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(table(spark, sf_dir, "pages"), RULES)


def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(table(spark, sf_dir, "documents"), vocabulary())


def op10_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held = remainder("doc_id", 3) == 1
    model = language.fit(docs.where(~held))
    got = language.predict(docs.select("doc_id", "text"), model)
    return got.select("doc_id", held.alias("held_out"), F.col("_lang_pred").alias("lang_pred"), F.col("_score").alias("score"), F.col("_langs").alias("langs"))


QUERIES = {
    "op1_near_dedup": op1_near_dedup,
    "op2_lm": op2_lm,
    "op3_warc": op3_warc,
    "op4_sharding": op4_sharding,
    "op5_mixing": op5_mixing,
    "op6_embeddings": op6_embeddings,
    "op7_quality": op7_quality,
    "op8_urls": op8_urls,
    "op9_bpe": op9_bpe,
    "op10_language": op10_language,
}
#: DuckDB SQL. op2, op5, op7, op9 and op10 rest on hashes of Spark, EM or merges, which SQL lacks.
ORACLE_SQL: dict[str, str] = {
    "op1_near_dedup": r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words FROM documents
), s AS (
  SELECT doc_id, CASE WHEN len(words) < 2 THEN words ELSE list_sort(list_distinct(list_transform(range(1, len(words)), lambda i: words[i] || ' ' || words[i + 1]))) END AS own FROM w
), c AS (
  SELECT own, min(doc_id) AS rep, len(own) AS n FROM s WHERE len(own) > 0 GROUP BY own
), t AS (
  SELECT rep, n, unnest(own) AS g FROM c
), links AS (
  SELECT a.rep AS a, b.rep AS b FROM t a JOIN t b ON a.g = b.g AND a.rep < b.rep GROUP BY a.rep, b.rep HAVING 100 * count(*) >= 80 * (any_value(a.n) + any_value(b.n) - count(*))
), reach AS (
  SELECT rep AS a, rep AS b FROM c
  UNION
  SELECT r.a, l.b FROM reach r JOIN (SELECT a, b FROM links UNION ALL SELECT b, a FROM links) l ON r.b = l.a
), named AS (SELECT a, min(b) AS component FROM reach GROUP BY a)
SELECT s.doc_id, len(s.own)::BIGINT AS n_shingles, coalesce(n.component, s.doc_id) AS component_id, coalesce(n.component, s.doc_id) = s.doc_id AS kept
FROM s LEFT JOIN c ON c.own = s.own LEFT JOIN named n ON n.a = c.rep
""",
    "op3_warc": r"""
WITH p AS (
  SELECT page_id, octet_length(encode(coalesce(html, '')))::BIGINT AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages
), f AS (
  SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first FROM p
)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN payload_bytes >= 100 AND first <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= 100 AND first <> page_id THEN first END AS refers_to FROM f
""",
    "op4_sharding": r"""
WITH k AS (
  SELECT list_transform(range(256), lambda n: list_reduce([n, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, x: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS steps
), b AS (
  SELECT doc_id, octet_length(encode(coalesce(text, '')))::BIGINT + 16 AS size,
    list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'), lambda h: ('0x' || h)::BIGINT) AS bytes FROM documents
), d AS (
  SELECT doc_id, size, xor(list_reduce(list_prepend(4294967295, bytes), lambda c, x: xor(c >> 8, steps[(xor(c, x) & 255) + 1])), 4294967295)::BIGINT AS text_crc32 FROM b, k
), e AS (
  SELECT *, sum(size) OVER (ORDER BY doc_id NULLS FIRST, text_crc32, size ROWS UNBOUNDED PRECEDING) AS upto, sum(size) OVER () AS every,
    row_number() OVER (ORDER BY doc_id NULLS FIRST, text_crc32, size) AS place FROM d
), f AS (SELECT *, least(39, (2 * upto - size) * 40 // (2 * every))::INTEGER AS shard FROM e)
SELECT doc_id, size, text_crc32, 'bytes' AS law, shard, row_number() OVER (PARTITION BY shard ORDER BY place) - 1 AS slot, NULL::INTEGER AS grown_shard FROM f
""",
    "op6_embeddings": r"""
WITH RECURSIVE v AS (
  SELECT vec_id, embedding::DOUBLE[] AS x FROM embeddings
), good AS (
  SELECT vec_id, x FROM v WHERE x IS NOT NULL AND len(list_filter(x, lambda y: y IS NULL OR NOT isfinite(y))) = 0 AND len(list_filter(x, lambda y: y <> 0)) > 0
), links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM good a JOIN good b ON a.vec_id <> b.vec_id AND len(a.x) = len(b.x) WHERE list_cosine_similarity(a.x, b.x) >= 0.95
), reach AS (
  SELECT vec_id AS a, vec_id AS b FROM v
  UNION
  SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a
), named AS (
  SELECT a, min(b) AS component_id FROM reach GROUP BY a
), n AS (SELECT a, count(*) AS n_links FROM links GROUP BY a)
SELECT named.a AS vec_id, coalesce(n_links, 0)::BIGINT AS n_links, component_id, component_id = named.a AS kept FROM named LEFT JOIN n USING (a)
""",
    "op8_urls": r"""
WITH RECURSIVE rules(h, b, v) AS (
  VALUES ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'), ('com', '/fr/', 'allow'), ('com', '/de/', 'block')
), tags AS (
  SELECT url, unnest(list_concat(regexp_extract_all(html, '(?is)<link\b[^>]*\brel\s*=\s*["'']?canonical\b[^>]*>'), regexp_extract_all(html, '(?is)<meta\b[^>]*\bhttp-equiv\s*=\s*["'']?refresh\b[^>]*>'))) AS tag FROM pages
), links AS (
  SELECT url AS source, replace(regexp_extract(tag, '(?is)\b(?:href|url)\s*=\s*["'']?([^"''\s>]+)', 1), '&amp;', '&') AS target FROM tags
), urls AS (
  SELECT url FROM pages UNION SELECT source FROM links UNION SELECT target FROM links
), parts AS (
  SELECT url, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM urls
), split AS (
  SELECT url, translate(regexp_extract(rest, '(?s)^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(rest, '(?s)^[^/?#]*([^?#]*)', 1) AS path, regexp_extract(rest, '(?s)^[^?#]*\?([^#]*)', 1) AS query FROM parts
), keyed AS (
  SELECT url, host, path, CASE WHEN strpos(url, '://') > 0 THEN
    concat_ws(chr(10), host, rtrim(path, '/'), trim(regexp_replace('&' || query, '(?i)&(?:utm_[a-z]+|ref|fbclid|gclid)=[^&]*', '', 'g'), '&')) END AS node FROM split
), fits AS (
  SELECT k.url, arg_max(h || b, length(h || b)) AS rule, arg_max(v, length(h || b)) AS own FROM keyed k JOIN rules ON (k.host = h OR ends_with(k.host, '.' || h)) AND starts_with(k.path, b) GROUP BY k.url
), edges AS (
  SELECT s.node AS a, t.node AS b FROM links l JOIN keyed s ON s.url = l.source JOIN keyed t ON t.url = l.target WHERE s.node <> t.node
), reach AS (
  SELECT node AS a, node AS b FROM keyed WHERE node IS NOT NULL
  UNION
  SELECT r.a, e.b FROM reach r JOIN (SELECT a, b FROM edges UNION ALL SELECT b, a FROM edges) e ON r.b = e.a
), said AS (
  SELECT r.a AS node, bool_or(f.own = 'allow') AS allow, bool_or(f.own = 'block') AS block FROM reach r JOIN keyed k ON k.node = r.b JOIN fits f ON f.url = k.url GROUP BY r.a
)
SELECT p.page_id, coalesce(k.host, '') AS host, coalesce(k.path, '') AS path, f.rule, coalesce(f.own, CASE WHEN s.allow THEN 'allow' WHEN s.block THEN 'block' ELSE 'allow' END) AS verdict
FROM pages p LEFT JOIN keyed k ON k.url = p.url LEFT JOIN fits f ON f.url = p.url LEFT JOIN said s ON s.node = k.node
""",
}
