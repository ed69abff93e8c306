"""Keep-first / keep-last per key and whole-row duplicate handling.

Keep-first/last is an aggregation, not a window: ``min``/``max`` over a
struct whose leading fields are the ordering columns.  Spark plans it as a
partial aggregate before the shuffle and a final one after, so a key holding
a large share of all rows is reduced to one row per map task before it moves;
a ``row_number`` window would sort every row of that key in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from billow.spec import ORDINAL

_WIN = "__pick"


def _q(name: str) -> Column:
    return F.col(f"`{name}`")


def keep_latest(df: DataFrame, key: Sequence[str], order_by: Sequence[str],
                latest: bool = True) -> DataFrame:
    """One row per ``key`` (nulls form one group): the last (or first) by ``order_by``.

    Ties on ``order_by`` are broken by the remaining columns, so the result is
    deterministic.  Column order is preserved.
    """
    key = list(key)
    # an ordering column is carried once
    held = {c: f"__o{i}" for i, c in reversed([*enumerate(order_by)])}
    fields = [_q(c).alias(f"__o{i}") for i, c in enumerate(order_by)]
    fields += [_q(c) for c in df.columns if c not in key and c not in held]
    pick = F.max if latest else F.min
    picked = df.groupBy(*[_q(k) for k in key]).agg(pick(F.struct(*fields)).alias(_WIN))
    return picked.select(*[
        (_q(c) if c in key else F.col(_WIN).getField(held.get(c, c)).alias(c)) for c in df.columns
    ])


def keep_last(df: DataFrame, key: Sequence[str], order_by: Sequence[str] = (ORDINAL,)) -> DataFrame:
    return keep_latest(df, key, order_by, latest=True)


def keep_first(df: DataFrame, key: Sequence[str], order_by: Sequence[str] = (ORDINAL,)) -> DataFrame:
    return keep_latest(df, key, order_by, latest=False)


def _data_columns(df: DataFrame, exclude: Sequence[str]) -> list[str]:
    return [c for c in df.columns if c not in set(exclude)]


def drop_row_duplicates(df: DataFrame, exclude: Sequence[str] = (ORDINAL,)) -> DataFrame:
    """Drop whole-row duplicates (null equals null), ignoring ``exclude`` columns.

    When an ordinal column is present the earliest copy's ordinal is kept.
    """
    cols = _data_columns(df, exclude)
    extra = [c for c in df.columns if c in set(exclude)]
    if not extra:
        return df.dropDuplicates()
    agg = df.groupBy(*[_q(c) for c in cols]).agg(*[F.min(_q(c)).alias(c) for c in extra])
    return agg.select(*[_q(c) for c in df.columns])


def duplicate_groups(df: DataFrame, cols: Sequence[str] | None = None,
                     exclude: Sequence[str] = (ORDINAL,),
                     count_name: str = "duplicate_count") -> DataFrame:
    """Value combinations that occur more than once, with their count."""
    cols = list(cols) if cols else _data_columns(df, exclude)
    return (df.groupBy(*[_q(c) for c in cols])
              .agg(F.count(F.lit(1)).alias(count_name))
              .where(F.col(count_name) > 1))


def row_hashes(columns: Sequence[str], hashes: int = 2) -> list[Column]:
    """64-bit hashes of a whole row.  Null flags are hashed along: a hash passes over nulls, so
    ``(a, null)`` and ``(null, a)`` would be one row without them."""
    parts = [x for c in columns for x in (_q(c).isNull(), _q(c))]
    return [F.xxhash64(F.lit(seed), *parts).alias(f"__h{seed}") for seed in range(1, hashes + 1)]


def distinct_rows(df: DataFrame, exclude: Sequence[str] = (ORDINAL,), sums: dict[str, Column] | None = None, hashes: int = 2,
                  by: Sequence[str] = ()) -> DataFrame:
    """One row for each distinct row of ``df``: ``__cnt`` copies, and ``sums`` over them.

    Groups by 128 bits of hash, so 16 bytes a row are shuffled instead of the row: two different rows
    of n share them with a probability of about n^2 / 2^129 (1e-15 for 1e12 rows).
    ``hashes``: 1 groups by 64 bits.  Equal rows still meet, so a table without copies by one hash has none;
    found copies may be different rows of one hash, and have to be counted by two.
    ``by``: columns that ``df`` is stored in buckets of; grouped by them too, its rows need no shuffle."""
    sums = sums or {}
    keyed = df.select(*by, *row_hashes(_data_columns(df, exclude), hashes), *[c.alias(n) for n, c in sums.items()])
    return keyed.groupBy(*by, *[f"__h{i}" for i in range(1, hashes + 1)]).agg(F.count(F.lit(1)).alias("__cnt"), *[F.sum(n).alias(n) for n in sums])


def row_duplicate_count(df: DataFrame, exclude: Sequence[str] = (ORDINAL,),
                        name: str = "duplicate_rows") -> DataFrame:
    """One row: number of rows beyond the first copy of each distinct row (0 if none)."""
    return distinct_rows(df, exclude).agg(F.coalesce(F.sum(F.col("__cnt") - 1), F.lit(0)).cast("bigint").alias(name))
