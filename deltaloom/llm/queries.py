"""Queries over the documents table, one for each operator, and their SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .bpe import bpe_digests
from .common import documents, tokenizer_pattern, tokenizer_path
from .conversations import conversation_repairs
from .divergence import source_divergence
from .exact_dedup import exact_dedup
from .fingerprints import fingerprint_edits
from .language import fold_of, identify_languages
from .line_dedup import line_dedup_report
from .lm_scoring import lm_scores
from .mixing import mix_sources
from .near_dedup import near_duplicates
from .simhash import simhash_components
from .substring_dedup import substring_digests
from .token_files import token_file_digests


def op1_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base and model scores of every whole text, learned from the folds but 1."""
    return lm_scores(documents(spark, sf_dir), tokenizer_path("byte_bpe_50k.tiktoken"), tokenizer_pattern())


def op2_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mix takes of every document."""
    return mix_sources(documents(spark, sf_dir)).select("doc_id", "size", "source_size", "target", "taken")


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The row that stays of each group of equal texts, a row a document."""
    return exact_dedup(documents(spark, sf_dir))


def op5_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of every text's ids and of their decoding."""
    return bpe_digests(documents(spark, sf_dir), tokenizer_path("byte_bpe_50k.tiktoken"), tokenizer_pattern())


def op8_fingerprint_edits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every text and its edited text, and their likeness."""
    return fingerprint_edits(documents(spark, sf_dir))


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines that repeat an earlier or similar one, a row a document."""
    return line_dedup_report(documents(spark, sf_dir))


def op6_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class of near duplicates of every document."""
    return near_duplicates(documents(spark, sf_dir)).select("doc_id", "class_id", "copies", "kept")


def op3_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned from the folds but 0."""
    found = identify_languages(documents(spark, sf_dir), held_fold=0)
    return found.select("doc_id", F.coalesce(fold_of(F.col("doc_id")) == 0, F.lit(False)).alias("held_out"), "lang_pred", "score")


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document that no repeated window of 35 words covers."""
    return substring_digests(documents(spark, sf_dir))


def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Start, length and checksum of every document's ids as read back from the token files."""
    return token_file_digests(documents(spark, sf_dir), tokenizer_path("byte_bpe_50k.json"))


def op11_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints and components of near fingerprints of all documents."""
    return simhash_components(documents(spark, sf_dir))


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults, cheapest repair and repaired digest of every damaged conversation."""
    return conversation_repairs(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Divergence of all pairs of sources of each language, and the ten terms that set each source apart."""
    return source_divergence(documents(spark, sf_dir))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {"op1_lm_scoring": op1_lm_scoring, "op2_mix_sources": op2_mix_sources, "op3_language": op3_language, "op4_exact_dedup": op4_exact_dedup, "op5_bpe_round_trip": op5_bpe_round_trip, "op6_near_duplicates": op6_near_duplicates, "op7_token_files": op7_token_files, "op8_fingerprint_edits": op8_fingerprint_edits, "op9_substring_dedup": op9_substring_dedup, "op10_line_dedup": op10_line_dedup, "op11_simhash": op11_simhash, "op12_conversation_repair": op12_conversation_repair, "op13_source_divergence": op13_source_divergence}


def oracle_sql() -> dict[str, str]:
    return {"op2_mix_sources": OP2_SQL, "op4_exact_dedup": OP4_SQL, "op9_substring_dedup": OP9_SQL, "op13_source_divergence": OP13_SQL}


OP2_SQL = r"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size FROM documents
), k AS (
  SELECT *, floor(sqrt(size)) AS klass, floor(('0x' || substr(md5('7:' || coalesce('s' || doc_id::VARCHAR, 'n')), 1, 8))::BIGINT / 4294967296.0::DOUBLE * 32) AS slice FROM d
), s AS (
  SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source
), w AS (
  SELECT *, ([5.0, 2.0, 1.0]::DOUBLE[])[1 + (row_number() OVER (ORDER BY source IS NULL, source) - 1) % 3] AS weight FROM s
), r AS (
  SELECT *, source_size * 2.0::DOUBLE / weight AS ratio FROM w
), l AS (
  SELECT *, ((sum(source_size) OVER ())::DOUBLE * 1.5::DOUBLE - coalesce(sum(source_size) OVER (ORDER BY ratio, source IS NULL, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::DOUBLE * 2.0::DOUBLE)
    / sum(weight) OVER (ORDER BY ratio, source IS NULL, source ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM r
), t AS (
  SELECT source, source_size, coalesce(least(source_size * 2.0::DOUBLE, (SELECT max(level) FROM l WHERE ratio >= level) * weight), source_size * 2.0::DOUBLE) AS target FROM l
), n AS (
  SELECT k.*, row_number() OVER (PARTITION BY source ORDER BY klass, slice, size, doc_id IS NULL, doc_id) - 1 AS i FROM k
), c AS (
  SELECT n.doc_id, n.size, t.source_size, t.target, n.i, CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0 END AS each,
    ('0x' || substr(md5('7:' || coalesce('s' || n.source, 'n')), 1, 8))::BIGINT / 4294967296.0::DOUBLE AS u
  FROM n JOIN t ON n.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, source_size, target, ((floor((i + 1) * each + u) - floor(i * each + u)) * size)::BIGINT AS taken FROM c
"""

OP4_SQL = r"""
WITH d AS (
  SELECT doc_id, length(coalesce(text, '')) AS n_chars, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS norm FROM documents
)
SELECT doc_id, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY norm) AS group_size,
  doc_id = first_value(doc_id) OVER w AS kept, sha256(norm) AS text_sha256
FROM d WINDOW w AS (PARTITION BY norm ORDER BY n_chars DESC, doc_id)
"""

OP13_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS text FROM documents
), t AS (
  SELECT r, lang, source, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d
), k AS (
  SELECT lang, term, count(*) AS lang_n FROM t GROUP BY lang, term HAVING count(DISTINCT r) >= 10
), v AS (
  SELECT lang, count(*) AS terms, sum(lang_n)::HUGEINT AS lang_total FROM k GROUP BY lang
), g AS (
  SELECT DISTINCT lang, source FROM d
), c AS (
  SELECT t.lang, t.source, t.term, count(*) AS n FROM t JOIN k ON t.lang = k.lang AND t.term = k.term GROUP BY ALL
), n AS (
  SELECT lang, source, sum(n)::HUGEINT AS total FROM c GROUP BY lang, source
), p AS (
  SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n, (1 + 1000000000::HUGEINT * (coalesce(c.n, 0) + 2) // (coalesce(n.total, 0) + 2 * v.terms)) AS p, (1 + 1000000000::HUGEINT * (k.lang_n + 2) // (v.lang_total + 2 * v.terms)) AS q
  FROM g JOIN k ON g.lang = k.lang JOIN v ON v.lang = g.lang LEFT JOIN n ON n.lang = g.lang AND n.source = g.source LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term
), f AS (
  SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
), pairs AS (
  SELECT a.lang, a.source, b.source AS item, coalesce(f.value, 0)::BIGINT AS value FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN f ON f.lang = a.lang AND f.source = a.source AND f.item = b.source
), terms AS (
  SELECT lang, source, term AS item, ((p - q) * (p - q) // (p + q))::BIGINT AS value FROM p WHERE n > 0 AND p > q
)
SELECT lang, source, 'pair' AS part, item, value, (row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item))::INT AS rank FROM pairs
UNION ALL
SELECT lang, source, 'term' AS part, item, value, (row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item))::INT AS rank FROM terms QUALIFY rank <= 10
"""

OP9_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), p AS (
  SELECT r, unnest(w) AS word, generate_subscripts(w, 1) AS j FROM d
), g AS (
  SELECT r, j, word, CASE WHEN count(*) OVER w = 35 THEN string_agg(word, ' ') OVER w END AS g FROM p WINDOW w AS (PARTITION BY r ORDER BY j ROWS BETWEEN CURRENT ROW AND 34 FOLLOWING)
), s AS (
  SELECT g FROM g WHERE g IS NOT NULL GROUP BY g HAVING count(*) > 1
), c AS (
  SELECT g.r, g.j, g.word, max((s.g IS NOT NULL)::INT) OVER (PARTITION BY g.r ORDER BY g.j ROWS BETWEEN 34 PRECEDING AND CURRENT ROW) AS gone FROM g LEFT JOIN s ON g.g = s.g
), k AS (
  SELECT r, count(*) AS n_words, sum(gone)::BIGINT AS n_removed, string_agg(word, ' ' ORDER BY j) FILTER (gone = 0) AS kept FROM c GROUP BY r
)
SELECT doc_id, coalesce(n_words, 0)::BIGINT AS n_words, coalesce(n_removed, 0)::BIGINT AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256 FROM d LEFT JOIN k ON d.r = k.r
"""
