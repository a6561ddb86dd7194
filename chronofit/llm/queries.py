"""Registered queries of the training-data operators: thin wrappers over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import language_id, learned_partitions, license_scan, lm_scores, lz_fingerprint, mixing, near_dedup, packing, phrase_mining, quality_rules, suffix_dedup, token_alignment, url_filter
from .common import read


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text statistics, base rule and learned decision list over ``documents`` (labels: ``labels``)."""
    out = quality_rules.judge_quality(read(spark, sf_dir, "documents", "doc_id", "text"),
                                      read(spark, sf_dir, "labels", "doc_id", "quality"))
    return out.select(F.col("id").alias("doc_id"), "n_words", "word_chars", "n_symbols", "n_dup_lines",
                      "n_repeat_words", "base_failed", "kept", "rule")


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Languages of ``documents`` by profiles learned from those that are not held out."""
    return language_id.predict_languages(read(spark, sf_dir, "documents", "doc_id", "text", "lang")).select(
        F.col("id").alias("doc_id"), "held_out", "lang_pred", "score")


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Canonical digests of ``documents`` looked up among the known licences and notices."""
    return license_scan.scan_licenses(read(spark, sf_dir, "documents", "doc_id", "text")).withColumnRenamed("id", "doc_id")


def op4_lz_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lempel-Ziv fingerprints of ``documents``, of their edited texts, and their likeness."""
    return lz_fingerprint.fingerprint_documents(read(spark, sf_dir, "documents", "doc_id", "text")).withColumnRenamed("id", "doc_id")


def op5_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stupid-backoff score per word of ``documents`` under the counts of all of them."""
    return lm_scores.score_documents(read(spark, sf_dir, "documents", "doc_id", "text")).select(
        F.col("id").alias("doc_id"), "n_words", "n_backoffs", F.round(F.col("log_score") / F.nullif("n_words", F.lit(0)), 6).alias("score"))


def tokenizer_path() -> str:
    """The vocabulary of the packing query; executors have the same file at the same place."""
    import public_tokenizers
    return str(public_tokenizers.path("word_bpe_49k.json"))


def op6_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``documents`` packed into sequences of 2048 tokens."""
    return packing.pack_documents(read(spark, sf_dir, "documents", "doc_id", "text"), tokenizer_path()).withColumnRenamed("id", "doc_id")


def op7_superminhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate groups of ``documents``: 3-word shingles, similarity 0.85 or more."""
    return near_dedup.group_near_duplicates(read(spark, sf_dir, "documents", "doc_id", "text"), k=3, percent=85
                                            ).withColumnRenamed("id", "doc_id")


def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rules and propagated host reputation over ``pages``."""
    return url_filter.judge_urls(read(spark, sf_dir, "pages", "page_id", "url", "html")).withColumnRenamed("id", "page_id")


def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repeated 100-byte strings removed from ``documents``."""
    return suffix_dedup.remove_repeats(read(spark, sf_dir, "documents", "doc_id", "text")).withColumnRenamed("id", "doc_id")


def op10_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mix of ``documents`` by source."""
    return mixing.mix(read(spark, sf_dir, "documents", "doc_id", "text", "source")).select(
        F.col("id").alias("doc_id"), "size", "source_size", "target", "epochs", "copies", "taken")


def op11_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 2,000 strongest collocations of each language of ``documents``."""
    return phrase_mining.mine_phrases(read(spark, sf_dir, "documents", "lang", "text"))


def op12_cross_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of ``documents`` under two tokenizers aligned, their pairs counted over all of them."""
    import public_tokenizers
    return token_alignment.align_tokenizers(
        read(spark, sf_dir, "documents", "doc_id", "text"), str(public_tokenizers.path("byte_bpe_50k.json")),
        str(public_tokenizers.path("piece_bpe_32k.model"))).withColumnRenamed("id", "doc_id")


def op13_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest rows of ``embeddings`` for every row whose id is divisible by 20."""
    return learned_partitions.search(read(spark, sf_dir, "embeddings", "vec_id", "embedding"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quality_rules": op1_quality_rules,
    "op2_language_id": op2_language_id,
    "op3_license_scan": op3_license_scan,
    "op4_lz_fingerprint": op4_lz_fingerprint,
    "op5_lm_scores": op5_lm_scores,
    "op6_best_fit_packing": op6_best_fit_packing,
    "op7_superminhash_dedup": op7_superminhash_dedup,
    "op8_url_filter": op8_url_filter,
    "op9_suffix_dedup": op9_suffix_dedup,
    "op10_source_mix": op10_source_mix,
    "op11_phrase_collocations": op11_phrase_collocations,
    "op12_cross_tokenizer_alignment": op12_cross_tokenizer_alignment,
    "op13_nearest_neighbours": op13_nearest_neighbours,
}

ORACLES: dict[str, str] = {
    "op3_license_scan": license_scan.oracle_sql(),
    "op5_lm_scores": lm_scores.oracle_sql(),
    "op8_url_filter": url_filter.oracle_sql(),
}
