"""One query per operator, over the whole of its table, with production parameters."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from billow.llm import (hard_negatives, hash_index, line_crf, line_dedup, ngram_join, piece_sampling, pitman_yor, quality_rules, sanitise,
                        source_mixing, spelling_groups, spot_signatures, token_counts)
from billow.llm.common import table
from billow.llm.oracles import ORACLE  # noqa: F401 - read by the entry file


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"),
                                     public_tokenizers.path("byte_bpe_50k.json"))


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality_rules.quality_rules(table(spark, sf_dir, "documents"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op1_piece_sampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digest and length of each document's sampled ids, and whether they decode to its text."""
    path = public_tokenizers.path("piece_bpe_32k.model")
    coded = piece_sampling.round_trip(table(spark, sf_dir, "documents").select("doc_id", "text"), path, F.col("doc_id"))
    return coded.select("doc_id", F.size("ids").alias("n_pieces"), F.xxhash64("ids").alias("ids_digest"), "lossless")


#: Target token shares of (quality, toxic).
MIXTURE = {(1, 0): 0.90, (1, 1): 0.04, (0, 0): 0.05, (0, 1): 0.01}


def op2_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    rates = source_mixing.mixing_rates(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), MIXTURE)
    return rates.select("doc_id", "tokens", "domain", "rate",
                        source_mixing.copies(F.col("rate"), F.col("doc_id"), F.col("text_key")).alias("copies"))


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.dedup_report(table(spark, sf_dir, "documents"))


def op4_line_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_crf.line_crf_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    joined = ngram_join.ngram_jaccard_join(table(spark, sf_dir, "documents"), n=4, percent=85)
    return joined.select("doc_id", "n_shingles", "component_id")


def op8_pitman_yor(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pitman_yor.pitman_yor_scores(table(spark, sf_dir, "documents"))


def op9_sanitise(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sanitise.find_personal_data(table(spark, sf_dir, "documents"))


def op10_hash_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hash_index.nearest(table(spark, sf_dir, "embeddings"), every=50, k=5)


def op11_spot_signatures(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spot_signatures.edited_fingerprints(table(spark, sf_dir, "documents"))


def op12_spelling_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_groups.spelling_groups(table(spark, sf_dir, "documents"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels of ids divisible by 7 are moved on by one."""
    return hard_negatives.hard_negatives(table(spark, sf_dir, "embeddings"), every=100, positives=5, negatives=10, low=30, high=90, relabel=7, labels=10)


QUERIES = {f.__name__: f for f in (op1_piece_sampling, op2_source_mixing, op3_line_dedup, op4_line_crf, op5_quality_rules,
                                    op6_token_counts, op7_ngram_jaccard_join, op8_pitman_yor, op9_sanitise, op10_hash_index,
                                    op11_spot_signatures, op12_spelling_groups, op13_hard_negatives)}
