"""Text expressions: sale type, churn flag, null tokens, dataset names."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from billow.spec import CHURN_STATUS_PATTERN, NULL_TOKENS, TAG_DELIMITER


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def sale_type(tag: Column | str, delimiter: str = TAG_DELIMITER) -> Column:
    """Part of the tag before the first delimiter, upper-cased.

    No delimiter -> the whole tag; leading delimiter -> empty text; no trim;
    null stays null.
    """
    return F.upper(F.split_part(_col(tag).cast("string"), F.lit(delimiter), F.lit(1)))


def churn_flag(status: Column | str | None, cancelled_at: Column | str | None,
               pattern: str = CHURN_STATUS_PATTERN) -> Column:
    """Churned if the lower-cased status matches the pattern or a cancel time is set.

    A null status counts as not matching; a missing column counts as all null.
    """
    by_status = (F.coalesce(F.lower(_col(status).cast("string")).rlike(pattern), F.lit(False))
                 if status is not None else F.lit(False))
    by_cancel = _col(cancelled_at).isNotNull() if cancelled_at is not None else F.lit(False)
    return (by_status | by_cancel).alias("is_churned")


def is_null_token(c: Column | str, tokens: tuple[str, ...] = NULL_TOKENS) -> Column:
    return _col(c).isin(list(tokens))


def null_tokens_to_null(c: Column | str, tokens: tuple[str, ...] = NULL_TOKENS) -> Column:
    """Exact-match (no trim) missing-value tokens -> null."""
    col = _col(c)
    return F.when(~col.isin(list(tokens)), col)


_NAME_SPACES = re.compile(r"\s+")


def normalise_dataset_name(file_name: str) -> str:
    """``Sales tags.csv`` -> ``sales_tags``: stem, lower case, spaces -> ``_``."""
    stem = file_name.rsplit("/", 1)[-1]
    if stem.lower().endswith(".csv"):
        stem = stem[:-4]
    return _NAME_SPACES.sub("_", stem.strip()).lower()
