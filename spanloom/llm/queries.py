"""Queries of the training-data operators, opN_<name>, and their SQL where SQL can say it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spanloom.llm import chat_format, decontaminate, html_extract, line_crf, mixing, pii, quality_gam, sharding, simhash, spelling, token_counts, toxicity, vector_codes

#: A public vocabulary file outside the repository.
VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_chat_prefix_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = r"\### Assistant: </turn> ok"
    tricky = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(text).alias("text"))
    rows = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(tricky)
    return chat_format.digest(chat_format.prefix_target_examples(rows))


def op2_simhash_golay(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicate_classes(_table(spark, sf_dir, "documents"))


def op3_hash_tree_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(_table(spark, sf_dir, "documents"), 40)


def op4_decontaminate_qgrams(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op5_html_max_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract_main_text(_table(spark, sf_dir, "pages"))


def op6_water_fill_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(_table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op7_quality_gam(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_gam.classify(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op8_line_crf_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_crf.line_rules(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op9_trie_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(_table(spark, sf_dir, "documents"), VOCABULARY)


def op10_pii_disclosure(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digest(pii.find_pii(_table(spark, sf_dir, "documents")))


def op11_kneser_ney_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.classify(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op12_spelling_dictionaries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_variants(_table(spark, sf_dir, "documents"))


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.compress(_table(spark, sf_dir, "embeddings"))


QUERIES = {
    f.__name__: f
    for f in (op1_chat_prefix_targets, op2_simhash_golay, op3_hash_tree_shards, op4_decontaminate_qgrams, op5_html_max_run, op6_water_fill_mix, op7_quality_gam, op8_line_crf_rules, op9_trie_token_counts, op10_pii_disclosure, op11_kneser_ney_toxicity, op12_spelling_dictionaries, op13_vector_codes)
}

ORACLE_SQL = {
    "op1_chat_prefix_targets": r"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
), numbered AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS n,
    length(text) + length(text) - length(replace(replace(text, '\', ''), '<', ''))
      + length(role) + length(role) - length(replace(replace(replace(role, '\', ''), '<', ''), '>', '')) + 16 AS written
  FROM rows
), uses AS (  -- a turn is written in each example from it on, and once in the rest where no reply follows
  SELECT *, sum(CASE WHEN role = 'assistant' THEN 1 ELSE 0 END) OVER (PARTITION BY conv_id ORDER BY n ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS examples
  FROM numbered
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY n)) AS turns_sha256,
  CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(CASE WHEN role = 'assistant' THEN text ELSE '' END, '' ORDER BY n), '')) AS loss_sha256,
  CAST(sum(written * greatest(examples, 1)) AS BIGINT) AS formatted_chars
FROM uses GROUP BY conv_id""",
    "op6_water_fill_mix": r"""
WITH d AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
    CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '') || ':17'), 1, 13) AS BIGINT) AS draw
  FROM documents
), s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source ASC NULLS LAST) AS rn FROM d GROUP BY source
), w AS (
  SELECT *, (rn - 1) % 3 + 1 AS weight, source_size * 3 AS cap FROM s
), k AS (
  SELECT *, row_number() OVER (ORDER BY cap / weight, weight, source_size, rn) AS k FROM w
), v AS (
  SELECT *, (CAST((SELECT sum(source_size) FROM w) AS BIGINT) - CAST(coalesce(sum(cap) OVER (ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT))
    / (CAST((SELECT sum(weight) FROM w) AS BIGINT) - CAST(coalesce(sum(weight) OVER (ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT)) AS level
  FROM k
), f AS (
  SELECT source, source_size, CASE WHEN level > cap / weight THEN CAST(cap AS DOUBLE) ELSE weight * (SELECT v2.level FROM v v2 WHERE v2.level <= v2.cap / v2.weight ORDER BY v2.k LIMIT 1) END AS target FROM v
), p AS (
  SELECT *, CASE WHEN source_size > 0 THEN CAST(round(target) AS BIGINT) // source_size ELSE 0 END AS whole FROM f
), q AS (
  SELECT *, CAST(round(target) AS BIGINT) - whole * source_size AS rest FROM p
), c AS (
  SELECT *, CAST(coalesce(sum(size) OVER (PARTITION BY source ORDER BY draw, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS before FROM d
)
SELECT c.doc_id, c.size, q.source_size, q.target, q.whole * c.size + greatest(0, least(c.size, q.rest - c.before)) AS taken
FROM c JOIN q ON c.source IS NOT DISTINCT FROM q.source""",
    "op13_vector_codes": r"""
WITH kept AS (
  SELECT vec_id, label, embedding, len(embedding) // 16 AS width FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), flat AS (
  SELECT vec_id, width, unnest(embedding) AS v, unnest(range(len(embedding))) AS i FROM kept
), parts AS MATERIALIZED (
  SELECT vec_id, i // width AS part, i % width AS pos, CAST(floor(256 * CAST(v AS DOUBLE)) AS BIGINT) AS x FROM flat
), book0 AS (
  SELECT e.part, dense_rank() OVER (ORDER BY e.vec_id) - 1 AS entry, e.pos, e.x FROM parts e WHERE e.vec_id IN (SELECT vec_id FROM kept ORDER BY vec_id LIMIT 64)
), far0 AS MATERIALIZED (
  SELECT p.vec_id, p.part, b.entry, sum((p.x - b.x) * (p.x - b.x)) AS apart FROM parts p JOIN book0 b ON p.part = b.part AND p.pos = b.pos GROUP BY ALL
), near0 AS MATERIALIZED (
  SELECT vec_id, part, min(apart) AS apart, arg_min(entry, apart * 64 + entry) AS entry FROM far0 GROUP BY ALL
), mean0 AS (
  SELECT p.part, n.entry, p.pos, CAST(floor(CAST(sum(p.x) AS DOUBLE) / count(*)) AS BIGINT) AS x FROM parts p JOIN near0 n ON p.vec_id = n.vec_id AND p.part = n.part GROUP BY ALL
), book1 AS MATERIALIZED (
  SELECT b.part, b.entry, b.pos, coalesce(m.x, b.x) AS x FROM book0 b LEFT JOIN mean0 m ON b.part = m.part AND b.entry = m.entry AND b.pos = m.pos
), far1 AS MATERIALIZED (
  SELECT p.vec_id, p.part, b.entry, sum((p.x - b.x) * (p.x - b.x)) AS apart FROM parts p JOIN book1 b ON p.part = b.part AND p.pos = b.pos GROUP BY ALL
), near1 AS MATERIALIZED (
  SELECT vec_id, part, min(apart) AS apart, arg_min(entry, apart * 64 + entry) AS entry FROM far1 GROUP BY ALL
), mean1 AS (
  SELECT p.part, n.entry, p.pos, CAST(floor(CAST(sum(p.x) AS DOUBLE) / count(*)) AS BIGINT) AS x FROM parts p JOIN near1 n ON p.vec_id = n.vec_id AND p.part = n.part GROUP BY ALL
), book2 AS MATERIALIZED (
  SELECT b.part, b.entry, b.pos, coalesce(m.x, b.x) AS x FROM book1 b LEFT JOIN mean1 m ON b.part = m.part AND b.entry = m.entry AND b.pos = m.pos
), far2 AS MATERIALIZED (
  SELECT p.vec_id, p.part, b.entry, sum((p.x - b.x) * (p.x - b.x)) AS apart FROM parts p JOIN book2 b ON p.part = b.part AND p.pos = b.pos GROUP BY ALL
), near2 AS MATERIALIZED (
  SELECT vec_id, part, min(apart) AS apart, arg_min(entry, apart * 64 + entry) AS entry FROM far2 GROUP BY ALL
), coded AS (
  SELECT vec_id, string_agg(printf('%02x', entry), '' ORDER BY part) AS code, CAST(sum(apart) AS BIGINT) AS error FROM near2 GROUP BY vec_id
), summed AS (
  SELECT k.label, CAST(sum(c.error) AS BIGINT) AS label_error FROM coded c JOIN kept k USING (vec_id) GROUP BY k.label
)
SELECT c.vec_id, c.code, c.error, s.label_error, (SELECT sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY part, entry, pos)) FROM book2) AS codebooks_sha256
FROM coded c JOIN kept k USING (vec_id) JOIN summed s ON s.label IS NOT DISTINCT FROM k.label""",
}
