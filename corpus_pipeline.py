"""Corpus pipeline: quality rules, line dedup, near-duplicate join, mixing, piece encoding.

Each stage takes (spark, docs, sf_dir), works on all that its predecessor kept and
returns the documents it keeps with the columns of ``documents``; the last one
returns them encoded.  A document is known to a stage by its id and text together,
so repeated rows share a decision and rows without id are judged by their text.
Empty tables go through all stages; null texts fail the quality rules.
"""

import public_tokenizers
from pyspark.sql import functions as F

from billow.llm import line_dedup, ngram_join, piece_sampling, quality_rules, source_mixing
from billow.llm.common import small, stored, table

#: A document that keeps less of its characters than this after line dedup goes whole.
KEEP_SHARE = 0.2
#: Near duplicates share this percentage of their word n-grams of this length.
NEAR_WORDS, NEAR_PERCENT = 5, 80
#: Target token shares of (quality, toxic); rates stay at 1 or below, so documents of a wanted domain stay whole.
MIXTURE = {(1, 0): 1.0}
PIECES = "piece_bpe_32k.model"


def without(docs, gone):
    """docs less the rows whose id and text are in gone (doc_id, text_key)."""
    rows = docs.withColumn("__text", F.xxhash64(F.coalesce("text", F.lit(""))))
    gone = small(stored(gone.select(F.col("doc_id").alias("__id"), F.col("text_key").alias("__key")).distinct(), "pipeline_gone"))
    same = F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("__text") == F.col("__key"))
    return rows.join(gone, same, "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])


def quality(spark, docs, sf_dir):
    """Documents that the base limits or the outlier test reject go."""
    judged = quality_rules.quality_rules(docs).groupBy("doc_id", "text_key").agg(F.max("kept").alias("kept"))
    return without(docs, judged.where("NOT kept"))


def lines(spark, docs, sf_dir):
    """Repeated lines go, and documents that are little else."""
    return line_dedup.dedup_lines(docs, keep_share=KEEP_SHARE)


def near_duplicates(spark, docs, sf_dir):
    """One document of each component stays: the one with the smallest id (rows without id: where no id is known)."""
    joined = ngram_join.ngram_jaccard_join(docs, n=NEAR_WORDS, percent=NEAR_PERCENT)
    return without(docs, joined.where("NOT (doc_id <=> component_id)"))


def mixing(spark, docs, sf_dir):
    """Documents stay with their rate as probability, drawn from their id and text."""
    rates = source_mixing.mixing_rates(docs, table(spark, sf_dir, "labels"), MIXTURE, max_rate=1.0)
    return without(docs, rates.where(source_mixing.copies(F.col("rate"), F.col("doc_id"), F.col("text_key")) < 1))


def encoding(spark, docs, sf_dir):
    """Sampled pieces of every document, and whether they decode to its text."""
    coded = piece_sampling.round_trip(docs.select("doc_id", "lang", "source", "text"), public_tokenizers.path(PIECES), F.col("doc_id"))
    return coded.select("doc_id", "lang", "source", "ids", F.size("ids").alias("n_pieces"), "lossless")


STAGES = [("quality rules", quality), ("line dedup", lines), ("n-gram Jaccard join", near_duplicates), ("mixing sources", mixing), ("piece encoding", encoding)]
#: The stages sample, fit and follow links: not expressible in SQL, tested against plain versions.
ORACLE_SQL = None


def run(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), "pipeline_" + name.replace(" ", "_"))
    return STAGES[-1][1](spark, docs, sf_dir)
