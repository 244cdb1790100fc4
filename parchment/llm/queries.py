"""The opN_<name> queries over whole tables, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parchment.llm.common import crc_mod, table
from parchment.llm.exact import exact_groups
from parchment.llm.langid import identify
from parchment.llm.license import duckdb_sql as license_sql
from parchment.llm.license import scan_licenses
from parchment.llm.lm_mixing import score as lm_score
from parchment.llm.mixing import mix
from parchment.llm.packing import pack_documents
from parchment.llm.quality import rate_documents
from parchment.llm.simhash import near_groups
from parchment.llm.substring import remove_repeats
from parchment.llm.winnow import edit_fingerprints


def op1_lm_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """log10 probabilities of all texts, learned where crc32 of the id modulo 7 is not 2."""
    return lm_score(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of 3-word shingles, linked at 2 or fewer differing bits."""
    out = near_groups(table(spark, sf_dir, "documents"), words=3, seed=42, threshold=2)
    return out.select(F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), F.col("component").alias("component_id"))


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words under windows of 13 words that a smaller document has too are removed."""
    return remove_repeats(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id").drop("kept")


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Languages of all texts, learned where crc32 of the id is no multiple of 5."""
    docs = table(spark, sf_dir, "documents")
    out = identify(docs, docs.where(crc_mod("doc_id", 5) != 0))
    return out.select(F.col("id").alias("doc_id"), (crc_mod("id", 5) == 0).alias("held_out"), "lang_pred", "score")


def op5_winnow(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every text and of its edited text."""
    return edit_fingerprints(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The row with the largest doc_id of each group of byte-equal texts stays."""
    out = exact_groups(table(spark, sf_dir, "documents"), keep="max")
    return out.select(F.col("id").alias("doc_id"), "keep_id", F.col("group_size").cast("long").alias("group_size"), "kept", F.col("digest").alias("text_sha256"))


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence phrases and templates in every document."""
    out = scan_licenses(table(spark, sf_dir, "documents"))
    return out.select(F.col("id").alias("doc_id"), "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")


def op8_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's tokens and end id in sequences of 2048."""
    out = pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), 2048)
    return out.withColumnRenamed("id", "doc_id")


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of all texts, learned where crc32 of the id modulo 4 is not 2."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels").select("doc_id", "quality")
    out = rate_documents(docs, lambda rows: rows.where(crc_mod("id", 4) != 2), labels.where(crc_mod("doc_id", 4) != 2))
    return out.select(F.col("id").alias("doc_id"), (crc_mod("id", 4) == 2).alias("held_out"), "score", "predicted")


def op10_entropy_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sources weigh 1, 2, 3, repeating, within 3 times their size; how often the mix takes each document."""
    out = mix(table(spark, sf_dir, "documents"))
    return out.select(F.col("id").alias("doc_id"), "size", "source_size", "target", "taken", "copies", "rate")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_lm_mixing": op1_lm_mixing,
    "op2_simhash": op2_simhash,
    "op3_substring_dedup": op3_substring_dedup,
    "op4_language_id": op4_language_id,
    "op5_winnow": op5_winnow,
    "op6_exact_dedup": op6_exact_dedup,
    "op7_license_scan": op7_license_scan,
    "op8_best_fit_packing": op8_best_fit_packing,
    "op9_quality": op9_quality,
    "op10_entropy_mix": op10_entropy_mix,
}

SQL: dict[str, str] = {
    "op6_exact_dedup": """
        SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
               row_number() OVER (PARTITION BY coalesce(text, '') ORDER BY doc_id DESC) = 1 AS kept,
               sha256(coalesce(text, '')) AS text_sha256
        FROM documents WINDOW g AS (PARTITION BY coalesce(text, ''))
    """,
    "op7_license_scan": license_sql(),
    "op3_substring_dedup": r"""
        WITH words AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
        places AS (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM words),
        windows AS (SELECT doc_id, i, array_to_string(w[i : i + 12], ' ') AS s FROM places),
        firsts AS (SELECT s, min(doc_id) AS d FROM windows GROUP BY s),
        gone AS (SELECT doc_id, list(DISTINCT i + k) AS p FROM (SELECT doc_id, i, unnest(range(0, 13)) AS k FROM windows JOIN firsts USING (s) WHERE d < doc_id) GROUP BY doc_id)
        SELECT doc_id, len(w)::BIGINT AS n_words, len(coalesce(p, []))::BIGINT AS n_removed,
               sha256(coalesce(array_to_string(CASE WHEN p IS NULL THEN w ELSE list_filter(w, lambda x, j: NOT list_contains(p, j)) END, ' '), '')) AS kept_sha256
        FROM words LEFT JOIN gone USING (doc_id)
    """,
}
