"""Not-null filters and null counts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def present(df: DataFrame, cols: Sequence[str]) -> list[str]:
    """The subset of ``cols`` that exists in ``df`` (a rule on a missing column is skipped)."""
    have = set(df.columns)
    return [c for c in cols if c in have]


def require_not_null(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Drop rows with a null in any required column that exists."""
    cols = present(df, cols)
    return df.dropna(how="any", subset=cols) if cols else df


def null_counts(df: DataFrame, cols: Sequence[str] | None = None,
                name_col: str = "column_name", count_col: str = "null_count") -> DataFrame:
    """Long form ``(column_name, null_count)`` from a single aggregation pass."""
    cols = list(cols) if cols is not None else list(df.columns)
    wide = df.agg(*[F.count_if(F.col(f"`{c}`").isNull()).cast("bigint").alias(f"n{i}")
                    for i, c in enumerate(cols)])
    pairs = [F.struct(F.lit(c).alias(name_col), F.col(f"n{i}").alias(count_col))
             for i, c in enumerate(cols)]
    return wide.select(F.inline(F.array(*pairs)))
