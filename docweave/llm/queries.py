"""The registered queries of this package and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from docweave.llm import (
    conversations,
    decontaminate,
    lines,
    mixing,
    ngram_join,
    perplexity,
    pii,
    secrets,
    site_quality,
    substrings,
    token_files,
    toxicity,
    whitening,
)
from docweave.session import fresh_dir

Query = Callable[[SparkSession, str], DataFrame]

BLANK = "[\\x20\\x09-\\x0D]"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.line_dedup_digest(_table(spark, sf_dir, "documents"))


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = toxicity.score_toxicity(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))
    return scored.withColumn("offending", F.array_join(F.col("offending").cast("array<string>"), ","))


def op2_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_sources(_table(spark, sf_dir, "documents")).drop("source")


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return perplexity.quality_rules(_table(spark, sf_dir, "documents"))


def op7_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = decontaminate.leak_report(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return report.withColumn("item_ids", F.array_join(F.col("item_ids").cast("array<string>"), ","))


def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.secret_digest(_table(spark, sf_dir, "documents"))


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.substring_digest(_table(spark, sf_dir, "documents"))


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.pii_digest(_table(spark, sf_dir, "documents"))


def op5_site_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return site_quality.score_quality(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op10_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.jaccard_components(_table(spark, sf_dir, "documents"), k=4, percent=85)


def op11_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(_table(spark, sf_dir, "embeddings"))


def op12_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.token_digest(_table(spark, sf_dir, "documents"), fresh_dir(spark, "token-shards"))


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations.repair_report(conversations.damage(_table(spark, sf_dir, "conversations")))


LINE_VIEWS = """
split_lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
  FROM documents),
keyed AS (
  SELECT doc_id, line, pos,
         translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM split_lines),
repeated AS (
  SELECT key, max(doc_id) AS keep FROM keyed WHERE length(key) >= 20
  GROUP BY key HAVING count(DISTINCT doc_id) >= 3),
judged AS (
  SELECT k.doc_id, k.line, k.pos, (r.key IS NOT NULL AND k.doc_id <> r.keep) AS dropped
  FROM keyed k LEFT JOIN repeated r ON k.key = r.key)
"""

OP6_SQL = f"""WITH {LINE_VIEWS}
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE dropped) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT dropped), '')) AS kept_sha256
FROM judged GROUP BY doc_id"""

OP8_SQL = """WITH
texts AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS words FROM documents),
windows AS (SELECT doc_id, words, unnest(range(1, len(words) - 11)) AS i FROM texts),
keyed AS (SELECT doc_id, i, array_to_string(words[i:i + 12], ' ') AS key FROM windows),
firsts AS (SELECT key, min(doc_id) AS least FROM keyed GROUP BY key),
covered AS (
  SELECT DISTINCT k.doc_id, k.i + g.step AS pos
  FROM keyed k JOIN firsts f ON k.key = f.key, range(0, 13) AS g(step) WHERE f.least < k.doc_id),
numbered AS (SELECT doc_id, unnest(words) AS word, generate_subscripts(words, 1) AS pos FROM texts),
kept AS (
  SELECT n.doc_id, count(c.pos) AS n_removed,
         string_agg(n.word, ' ' ORDER BY n.pos) FILTER (WHERE c.pos IS NULL) AS words
  FROM numbered n LEFT JOIN covered c ON n.doc_id = c.doc_id AND n.pos = c.pos GROUP BY n.doc_id)
SELECT t.doc_id, len(t.words) AS n_words, coalesce(k.n_removed, 0) AS n_removed,
       sha256(coalesce(k.words, '')) AS kept_sha256
FROM texts t LEFT JOIN kept k ON t.doc_id = k.doc_id"""


QUERIES: dict[str, Query] = {
    "op1_toxicity": op1_toxicity,
    "op2_mix_sources": op2_mix_sources,
    "op3_quality_rules": op3_quality_rules,
    "op4_secret_scan": op4_secret_scan,
    "op5_site_quality": op5_site_quality,
    "op6_line_dedup": op6_line_dedup,
    "op7_benchmark_decontamination": op7_benchmark_decontamination,
    "op8_substring_dedup": op8_substring_dedup,
    "op9_pii": op9_pii,
    "op10_ngram_jaccard_join": op10_ngram_jaccard_join,
    "op11_embedding_whitening": op11_embedding_whitening,
    "op12_token_files": op12_token_files,
    "op13_conversation_repair": op13_conversation_repair,
}
TWINS: dict[str, str] = {"op6_line_dedup": OP6_SQL, "op8_substring_dedup": OP8_SQL}
