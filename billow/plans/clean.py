"""Bronze -> silver cleaning (one dataset at a time), with dropped-row counts.

Order as in the reference: parse dates, keep the latest row per key (costs),
drop rows with a null required column, drop whole-row duplicates.

All steps after the date parse run as ONE aggregation (one shuffle):

* with a keep-last key, rows are grouped by that key; the group's latest
  row is picked by ``max(struct(order, row))``.  Keys are then unique, so the
  later whole-row dedupe cannot drop anything and is not planned at all.
* without one, rows are grouped by all data columns (the dedupe); the group
  size says how many copies each distinct row had.

The same grouped rows give every step's before/after count, so the report
needs no extra pass, and in a pipeline run the counts are observed while the
silver table is written.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from billow.functions.dates import dayfirst_date, lenient_date
from billow.operators.nulls import present
from billow.spec import ORDINAL, DatasetSpec

_N = "__copies"
_PICK = "__pick"
_LOST = "__lost_"  # prefix: 1 where parsing the column of that name nulled its text


def _q(name: str) -> Column:
    return F.col(f"`{name}`")


def parse_dates(df: DataFrame, spec: DatasetSpec, losses: bool = False) -> DataFrame:
    """Timestamp-like columns (by name pattern) -> UTC date; day-first columns -> date.

    ``losses``: also a column of 0 or 1 for each text column parsed (1: its text is no date)."""
    types = dict(df.dtypes)
    out, texts = [], []
    for c in df.columns:
        lc = c.lower()
        lenient = any(p in lc for p in spec.timestamp_name_parts)
        if c == ORDINAL or not (lenient or c in spec.dayfirst_date_columns):
            out.append(_q(c))
        elif types[c] != "string":
            out.append(F.to_date(_q(c)).alias(c))
        else:
            out.append((lenient_date(_q(c)) if lenient else dayfirst_date(_q(c), spec.date_order)).alias(c))
            texts.append(c)
    if not losses:
        return df.select(*out)
    # the text is carried beside its date, so that it is parsed once
    parsed = df.select(*out, *[_q(c).alias(f"__text_{c}") for c in texts])
    return parsed.select(*[_q(c) for c in df.columns], *[
        (_q(f"__text_{c}").isNotNull() & _q(c).isNull()).cast("int").alias(_LOST + c) for c in texts])


@dataclass
class Grouped:
    """Rows after the single cleaning aggregation, before the not-null filter."""

    rows: DataFrame          # data columns (+ ordinal) + ``__copies``
    columns: list[str]       # output columns in order
    keep_last: bool
    required: list[str]
    parsed: list[str]        # date columns with a ``__lost_`` count


def group_for_clean(parsed: DataFrame, spec: DatasetSpec, partitions: int | None = None, by: str | None = None) -> Grouped:
    """``partitions``, ``by``: the rows are first hash-partitioned in so many by that column, and grouped where they are
    (every grouping holds the column), so that what follows stays partitioned that way."""
    if partitions:
        parsed = parsed.repartition(partitions, _q(by))
    cols = [c for c in parsed.columns if not c.startswith(_LOST)]
    dates = [c[len(_LOST):] for c in parsed.columns if c.startswith(_LOST)]
    counts = [F.count(F.lit(1)).alias(_N), *[F.sum(_q(_LOST + c)).alias(_LOST + c) for c in dates]]
    kept = [F.col(_N), *[_q(_LOST + c) for c in dates]]
    # keep-last needs its whole key; with a key column missing the step is skipped
    key = list(spec.keep_last_by) if len(present(parsed, spec.keep_last_by)) == len(spec.keep_last_by) else []
    required = present(parsed, spec.required)
    order = [c for c in spec.order_by if c in cols]
    # the ordinal goes on into silver only when a later keep-first needs it
    out_cols = cols if spec.keep_row_order else [c for c in cols if c != ORDINAL]
    if key:
        payload = [c for c in out_cols if c not in key]
        fields = [_q(c).alias(f"__o{i}") for i, c in enumerate(order)] + [_q(c) for c in payload]
        g = parsed.groupBy(*[_q(k) for k in key]).agg(
            *counts, F.max(F.struct(*fields)).alias(_PICK))
        rows = g.select(*[(_q(c) if c in key else F.col(_PICK).getField(c).alias(c)) for c in out_cols], *kept)
        return Grouped(rows, out_cols, True, required, dates)
    data = [c for c in cols if c != ORDINAL]
    aggs = list(counts)
    if ORDINAL in out_cols:
        # first copy's ordinal: a struct minimum, planned as a sort aggregate
        aggs.append(F.min(_q(ORDINAL)).alias(ORDINAL))
    g = parsed.groupBy(*[_q(c) for c in data]).agg(*aggs)
    return Grouped(g.select(*[_q(c) for c in out_cols], *kept), out_cols, False, required, dates)


def _all_present(cols: list[str]) -> Column:
    cond = F.lit(True)
    for c in cols:
        cond = cond & _q(c).isNotNull()
    return cond


def cleaned(g: Grouped) -> DataFrame:
    return g.rows.where(_all_present(g.required)).select(*[_q(c) for c in g.columns])


def count_exprs(g: Grouped) -> tuple[list[Column], list[tuple[str, str, str]]]:
    """Aggregates over the grouped rows, and (step, before, after) names per step."""
    exprs = [F.sum(_N).cast("bigint").alias("rows_in")]
    steps = []
    prev = "rows_in"
    if g.keep_last:
        exprs.append(F.count(F.lit(1)).cast("bigint").alias("after_keep_last"))
        steps.append(("keep_last", prev, "after_keep_last"))
        prev = "after_keep_last"
    for i, c in enumerate(g.required):
        name = f"after_not_null_{i}"
        cond = _all_present(g.required[: i + 1])
        if g.keep_last:
            exprs.append(F.count_if(cond).cast("bigint").alias(name))
        else:
            exprs.append(F.coalesce(F.sum(F.when(cond, F.col(_N))), F.lit(0)).cast("bigint").alias(name))
        steps.append((f"not_null:{c}", prev, name))
        prev = name
    exprs.append(F.count_if(_all_present(g.required)).cast("bigint").alias("after_dedupe"))
    steps.append(("dedupe", prev, "after_dedupe"))
    return exprs, steps


def loss_exprs(g: Grouped) -> dict[str, Column]:
    """Name -> count of the values that a date parse nulled, by column (over all bronze rows)."""
    return {f"lost_{i}": F.coalesce(F.sum(_q(_LOST + c)), F.lit(0)).cast("bigint").alias(f"lost_{i}") for i, c in enumerate(g.parsed)}


def clean_dataset(df: DataFrame, spec: DatasetSpec) -> DataFrame:
    """Silver rows of one dataset (lazy)."""
    return cleaned(group_for_clean(parse_dates(df, spec), spec))


def dropped_rows_report(df: DataFrame, spec: DatasetSpec) -> DataFrame:
    """``(dataset, step, rows_before, rows_after, rows_dropped)`` from one aggregation."""
    g = group_for_clean(parse_dates(df, spec), spec)
    exprs, steps = count_exprs(g)
    wide = g.rows.agg(*exprs)
    items = [F.struct(F.lit(spec.name).alias("dataset"), F.lit(step).alias("step"),
                      F.coalesce(F.col(b), F.lit(0)).alias("rows_before"),
                      F.coalesce(F.col(a), F.lit(0)).alias("rows_after"),
                      (F.coalesce(F.col(b), F.lit(0)) - F.coalesce(F.col(a), F.lit(0))).alias("rows_dropped"))
             for step, b, a in steps]
    return wide.select(F.inline(F.array(*items)))


def steps_from_counts(name: str, counts: dict, steps: list[tuple[str, str, str]]) -> list[tuple]:
    """Report rows from counts observed during a write."""
    out = []
    for step, b, a in steps:
        before, after = int(counts.get(b) or 0), int(counts.get(a) or 0)
        out.append((name, step, before, after, before - after))
    return out
