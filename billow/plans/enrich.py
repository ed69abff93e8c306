"""Subscriptions enriched with their sale type (from sales tags)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from billow.functions.text import sale_type
from billow.operators.joins import left_join
from billow.spec import COLS, ORDINAL, BillingColumns

TAG_ORDER = "__tag_order"


def sale_type_pairs(tags: DataFrame, cols: BillingColumns = COLS, partitions: int | None = None) -> DataFrame:
    """Distinct ``(subscription_id, sale_type)``; with an ordinal, the first occurrence's.

    ``partitions``: hash-partitioned in so many by subscription, grouped where they are."""
    if partitions:
        tags = tags.repartition(partitions, cols.subscription_id)
    t = tags.select(F.col(cols.subscription_id), sale_type(cols.tag).alias("sale_type"),
                    *([F.col(ORDINAL)] if ORDINAL in tags.columns else []))
    if ORDINAL in t.columns:
        return t.groupBy(cols.subscription_id, "sale_type").agg(F.min(ORDINAL).alias(ORDINAL))
    return t.distinct()


def enrich_subscriptions(subs: DataFrame, tags: DataFrame | None,
                         cols: BillingColumns = COLS, partitions: int | None = None) -> DataFrame:
    """Left join of the distinct sale-type pairs; a subscription with several types
    gets one row per type (as in the reference), one with none gets a null type.

    ``partitions``: ``subs`` is hash-partitioned in so many by subscription; the tags are too, and joined where they are.
    Without a usable tags table the subscriptions pass through unchanged.
    """
    if tags is None or cols.subscription_id not in tags.columns or cols.tag not in tags.columns:
        return subs
    if partitions:
        tags = tags.where(F.col(cols.subscription_id).isNotNull())  # joins nothing
    pairs = sale_type_pairs(tags, cols, partitions)
    if ORDINAL in pairs.columns:
        pairs = pairs.withColumnRenamed(ORDINAL, TAG_ORDER)
    joined = left_join(subs, pairs, [cols.subscription_id])
    out = []
    for c in subs.columns:
        if c == ORDINAL:
            parts = [F.col(ORDINAL).alias("row")]
            if TAG_ORDER in joined.columns:
                parts.append(F.col(TAG_ORDER).alias("tag"))
            out.append(F.struct(*parts).alias(ORDINAL))
        else:
            out.append(F.col(f"`{c}`"))
    out.append(F.col("sale_type"))
    return joined.select(*out)
