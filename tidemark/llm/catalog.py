"""Registered queries of the operators and their DuckDB SQL, where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import (bpe, chat, embedding_dedup, hard_negatives, language_model, mixing, quality, simhash,
                          speculative_bpe, token_alignment, token_counts, topk, url_filter)
from tidemark.llm.common import id_remainder, read_table

Query = Callable[[SparkSession, str], DataFrame]


def op1_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(read_table(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash.hex_fingerprint().alias("fingerprint"), "component_id")


def op2_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    coded = bpe.encode_documents(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    return coded.select("doc_id", F.size("token_ids").cast("bigint").alias("n_tokens"),
                        F.sha2(F.array_join(F.col("token_ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
                        F.sha2("decoded", 256).alias("decoded_sha256"))


def op3_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality.fit(docs, read_table(spark, sf_dir, "labels"))
    scored = quality.score_quality(docs, model)
    return scored.select("doc_id", (id_remainder("doc_id", 3) == 1).alias("held_out"), "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op4_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(read_table(spark, sf_dir, "embeddings"))


OP4_SQL = """
WITH usable AS (
  SELECT row_number() OVER () AS k, vec_id, list_transform(embedding, lambda x: floor(64 * CAST(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.k, q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
  FROM usable q JOIN usable c ON q.k <> c.k
  WHERE q.vec_id % 20 = 0
), ranked AS (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY k ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
  FROM scored
)
SELECT * FROM ranked WHERE rank <= 20
"""


# The rules that the URL contract lists.
URL_RULES = [
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
]


def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, url_filter.RULES_SCHEMA)
    judged = url_filter.judge_urls(read_table(spark, sf_dir, "pages").select("page_id", "url"), rules)
    return judged.select("page_id", "host", "path", "rule", "verdict")


OP5_SQL = """
WITH cut AS (
  SELECT row_number() OVER () AS rid, page_id,
         CASE WHEN strpos(coalesce(url, ''), '://') = 0 THEN '' ELSE substr(url, strpos(url, '://') + 3) END AS rest
  FROM pages
), parts AS (
  SELECT rid, page_id,
         translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM cut
), rules(rule_host, rule_path, action) AS (
  VALUES ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'),
         ('com', '/fr/', 'allow'), ('com', '/de/', 'block')
), best AS (
  SELECT rid, arg_max(rule_host || rule_path, length(rule_host || rule_path)) AS rule,
         arg_max(action, length(rule_host || rule_path)) AS verdict
  FROM parts JOIN rules
    ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
  GROUP BY rid
)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict
FROM parts LEFT JOIN best USING (rid)
"""


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(read_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op7_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_model.score_documents(read_table(spark, sf_dir, "documents"))


def op8_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix_sizes(read_table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "rate", "copies")


def op9_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_duplicates(read_table(spark, sf_dir, "embeddings"))


OP9_SQL = """
WITH RECURSIVE every AS (
  SELECT row_number() OVER () AS k, vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
), usable AS (
  SELECT * FROM every
  WHERE v IS NOT NULL AND len(list_filter(v, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(v, lambda x: x <> 0)) > 0
), links AS (
  SELECT a.k AS a, b.k AS b, b.vec_id FROM usable a JOIN usable b ON a.k <> b.k
  WHERE list_cosine_similarity(a.v, b.v) >= 0.9
), reach AS (
  SELECT a, b, vec_id FROM links
  UNION
  SELECT reach.a, links.b, links.vec_id FROM reach JOIN links ON reach.b = links.a
), lowest AS (
  SELECT a, min(vec_id) AS low FROM reach GROUP BY a
), counts AS (
  SELECT a, count(*) AS n FROM links GROUP BY a
)
SELECT vec_id, coalesce(n, 0) AS n_links, least(vec_id, coalesce(low, vec_id)) AS component_id,
       vec_id = least(vec_id, coalesce(low, vec_id)) AS kept
FROM every LEFT JOIN lowest ON k = lowest.a LEFT JOIN counts ON k = counts.a
"""


def op10_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.format_chats(read_table(spark, sf_dir, "conversations"))


OP10_SQL = """
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text
  FROM conversations WHERE conv_id IS NOT NULL
), whole AS (
  SELECT conv_id, list({'role': role, 'text': text} ORDER BY turn) AS turns FROM turns GROUP BY conv_id
), prefixes AS (
  SELECT DISTINCT turns[1:n] AS turns FROM whole, unnest(range(1, len(turns))) AS r(n)
), first AS (
  SELECT min(conv_id) AS conv_id, turns FROM whole GROUP BY turns
), maximal AS (
  SELECT conv_id FROM first WHERE turns NOT IN (SELECT turns FROM prefixes)
)
SELECT conv_id, CAST(floor((pos - 1) / 1024) AS BIGINT) AS part, count(*) AS n_turns,
       string_agg('<|' || role || '|>' || chr(10) || text || '<|end|>' || chr(10), '' ORDER BY pos) AS text
FROM (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) AS pos FROM turns) t
WHERE conv_id IN (SELECT conv_id FROM maximal)
GROUP BY ALL
"""


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label").cast("bigint") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(read_table(spark, sf_dir, "embeddings").withColumn("label", moved))


OP11_SQL = """
WITH usable AS (
  SELECT row_number() OVER () AS k, vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v,
         CASE WHEN vec_id % 7 = 0 THEN (CAST(label AS BIGINT) + 1) % 10 ELSE label END AS label
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT a.k AS anchor, a.vec_id AS anchor_id, a.label = c.label AS same, c.k, c.vec_id,
         CAST(list_inner_product(a.v, c.v) AS BIGINT) AS score
  FROM usable a JOIN usable c ON a.k <> c.k
  WHERE a.vec_id % 100 = 0
), positives AS (
  SELECT * FROM (
    SELECT anchor, anchor_id, k, vec_id, score, row_number() OVER (PARTITION BY anchor ORDER BY score DESC, vec_id, k) AS n
    FROM scored WHERE same) p
  WHERE n <= 5
), ranked AS (
  SELECT p.anchor_id, p.vec_id AS positive_id, s.vec_id AS negative_id, p.score AS positive_score, s.score AS negative_score,
         row_number() OVER (PARTITION BY p.anchor, p.k ORDER BY s.score DESC, s.vec_id, s.k) AS n
  FROM positives p JOIN scored s ON s.anchor = p.anchor
  WHERE NOT s.same AND 80 * p.score <= 100 * s.score AND s.score <= p.score
)
SELECT anchor_id, positive_id, CAST(n AS INTEGER) AS rank, negative_id, positive_score, negative_score
FROM ranked WHERE n <= 5
"""


def op12_speculative_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    coded = speculative_bpe.encode_documents(docs, public_tokenizers.path("byte_bpe_50k.json"))
    return coded.select("doc_id", (F.octet_length("token_ids") / 4).cast("bigint").alias("n_tokens"),
                        F.sha2("token_ids", 256).alias("ids_sha256"),
                        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    paths = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
    aligned = token_alignment.align(read_table(spark, sf_dir, "documents"), *paths)
    digest = F.when(F.col("n_a") == 0, "").otherwise(F.sha2("groups", 256)).alias("groups_sha256")
    scored = token_alignment.score_links(aligned.select("*", digest).drop("groups"), *paths)
    return scored.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


QUERIES: dict[str, Query] = {
    "op1_simhash_near_dedup": op1_simhash_near_dedup,
    "op2_byte_bpe": op2_byte_bpe,
    "op3_quality_classifier": op3_quality_classifier,
    "op4_exact_top_k": op4_exact_top_k,
    "op5_url_filter": op5_url_filter,
    "op6_token_counts": op6_token_counts,
    "op7_lm_scoring": op7_lm_scoring,
    "op8_source_mixing": op8_source_mixing,
    "op9_embedding_near_dedup": op9_embedding_near_dedup,
    "op10_chat_formatting": op10_chat_formatting,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_speculative_bpe": op12_speculative_bpe,
    "op13_token_alignment": op13_token_alignment,
}

ORACLE: dict[str, str] = {
    "op4_exact_top_k": OP4_SQL,
    "op5_url_filter": OP5_SQL,
    "op9_embedding_near_dedup": OP9_SQL,
    "op10_chat_formatting": OP10_SQL,
    "op11_hard_negatives": OP11_SQL,
}
