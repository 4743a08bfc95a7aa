"""Registered queries of the llm operators (opN_<name>) and their DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import filter_audit as audit
from . import quality_rules as quality
from . import secret_scan as secrets
from . import warc_revisits as warc
from .best_fit_packing import best_fit_packing
from .byte_bpe import byte_bpe
from .common import table
from .embedding_near_dup import embedding_near_dups
from .ffd_packing import ffd_packing
from .importance_resampling import importance_resampling
from .license_scan import license_scan
from .ngram_jaccard_join import ngram_jaccard_components
from .token_counts import token_counts
from .toxicity import toxicity


def op1_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator 1 over all documents: five-word shingles, similarity 0.8 or more."""
    return ngram_jaccard_components(table(spark, sf_dir, "documents"))


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator 2 over all documents, with the public 50k byte-level tokenizer and a limit of 512 tokens."""
    return token_counts(table(spark, sf_dir, "documents")).withColumn("over_limit", F.col("n_tokens") > 512)


def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator 3 over all documents."""
    return secrets.secret_scan(table(spark, sf_dir, "documents"))


def op4_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator 4 over all documents: encoded by the public 50k ranks, then decoded."""
    return byte_bpe(table(spark, sf_dir, "documents"), digest=True)


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator 5 over all documents, learned from the labels outside the held-out fold."""
    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")).select("doc_id", "held_out", "score", "predicted")


def op6_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator 6 over all documents: sequences of at most 4096 tokens."""
    return best_fit_packing(table(spark, sf_dir, "documents"))


def op7_warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator 7 over all pages: each page's full capture and a later not-modified revisit of its URL."""
    resolved = warc.resolve_revisits(warc.captures_of_pages(table(spark, sf_dir, "pages")))
    return resolved.select(F.col("record_id").alias("page_id"), "url_key", "status", "response_id", warc.headers_digest("headers").alias("headers_sha256"))


def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator 8 over all documents, with the built-in phrases and templates."""
    return license_scan(table(spark, sf_dir, "documents")).drop("spans")


def op9_embedding_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator 9 over all embeddings: cosine 0.9 or more."""
    return embedding_near_dups(table(spark, sf_dir, "embeddings"))


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator 10 over all documents, with ``source`` as the host."""
    return quality.quality_rules(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op11_ffd_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator 11 over all documents: sequences of at most 1024 tokens."""
    return ffd_packing(table(spark, sf_dir, "documents"))


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator 12 over all documents and labels, per source."""
    return audit.filter_audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op13_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator 13 over all documents, towards the benchmark texts."""
    return importance_resampling(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("n_words")


QUERIES = {f.__name__: f for f in (
    op1_ngram_jaccard_join, op2_token_counts, op3_secret_scan, op4_byte_bpe, op5_toxicity, op6_best_fit_packing,
    op7_warc_revisits, op8_license_scan, op9_embedding_near_dup, op10_quality_rules, op11_ffd_packing,
    op12_filter_audit, op13_importance_resampling)}
ORACLE: dict[str, str] = {
    "op3_secret_scan": secrets.oracle_sql(),
    "op7_warc_revisits": warc.ORACLE_SQL,
    "op10_quality_rules": quality.ORACLE_SQL,
    "op12_filter_audit": audit.ORACLE_SQL,
}
