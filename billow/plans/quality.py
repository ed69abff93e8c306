"""Data-quality report, gate and reconciliations.

A report is a DataFrame ``(dataset, check, column_name, value, expected,
passed)``.  Per dataset, row count, key null counts and duplicate count all
come from one grouping of the whole row; only the (few dozen) report rows
ever reach the driver, in ``gate``.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DecimalType, LongType, StringType, StructField, StructType

from billow.functions.money import money
from billow.operators.dedup import distinct_rows
from billow.spec import COLS, MONEY_PRECISION, MONEY_SCALE, ORDINAL, POST_DQ_KEYS, BillingColumns

REPORT_SCHEMA = StructType([
    StructField("dataset", StringType()), StructField("check", StringType()),
    StructField("column_name", StringType()), StructField("value", LongType()),
    StructField("expected", LongType()), StructField("passed", BooleanType()),
])


class DataQualityError(RuntimeError):
    """Raised by ``gate`` when any check failed."""


def _literal_rows(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    return spark.createDataFrame(rows, REPORT_SCHEMA)


def _data(df: DataFrame) -> DataFrame:
    return df.drop(ORDINAL) if ORDINAL in df.columns else df


def _sql_text(v: str | None) -> str:
    return "CAST(NULL AS STRING)" if v is None else "'" + v.replace("'", "''") + "'"


def _row_sql(dataset: str, check: str, column: str | None, value: str, expected: str,
             passed: str) -> str:
    """One report row as a SQL struct over the columns of a one-row aggregate."""
    return (f"named_struct('dataset', {_sql_text(dataset)}, 'check', {_sql_text(check)}, "
            f"'column_name', {_sql_text(column)}, 'value', CAST({value} AS BIGINT), "
            f"'expected', CAST({expected} AS BIGINT), 'passed', CAST({passed} AS BOOLEAN))")


def _rows(one_row: DataFrame, rows: list[str]) -> DataFrame:
    return one_row.select(F.expr(f"inline(array({', '.join(rows)}))"))


def dataset_checks(name: str, df: DataFrame, keys: Sequence[str],
                   compare_rows: DataFrame | int | None = None, compare_label: str = "bronze_rows",
                   parity: bool = False, hashes: int = 2, by: Sequence[str] = ()) -> DataFrame:
    """Row count, emptiness, key presence, key nulls and duplicates of one table.

    All counts come from ONE grouping by the hash of the whole row: rows = sum of group
    sizes, duplicates = rows - groups, key nulls = sums over the groups.  Only hashes and
    counts are shuffled, after a partial aggregation, so many copies of one row never meet in one task.
    ``compare_rows``: the other layer, or its row count when already known
    (e.g. observed while it was written); reported (``parity``: must match).
    ``hashes``, ``by``: see ``distinct_rows``.
    """
    data = _data(df)
    present_keys = [k for k in keys if k in data.columns]
    groups = distinct_rows(data, (), {f"n{i}": F.col(f"`{k}`").isNull().cast("long") for i, k in enumerate(present_keys)}, hashes, by)
    stats = groups.agg(
        F.coalesce(F.sum("__cnt"), F.lit(0)).alias("rows"), F.count(F.lit(1)).alias("groups"),
        *[F.coalesce(F.sum(f"n{i}"), F.lit(0)).alias(f"n{i}") for i in range(len(present_keys))])
    items = [_row_sql(name, "row_count", None, "rows", "NULL", "NULL"),
             _row_sql(name, "not_empty", None, "rows", "NULL", "rows > 0")]
    for k in keys:
        if k in present_keys:
            n = f"n{present_keys.index(k)}"
            items.append(_row_sql(name, "null_count", k, n, "0", f"{n} = 0"))
        else:
            items.append(_row_sql(name, "key_present", k, "NULL", "NULL", "false"))
    items.append(_row_sql(name, "duplicate_rows", None, "rows - groups", "0", "rows - groups = 0"))
    out = _rows(stats, items)
    if compare_rows is not None:
        if isinstance(compare_rows, DataFrame):
            other = _data(compare_rows).agg(F.count(F.lit(1)).alias("o"))
            row = (_row_sql(name, "row_count_parity", None, "NULL", "o", "NULL") if parity
                   else _row_sql(name, compare_label, None, "o", "NULL", "NULL"))
            out = out.unionByName(_rows(other, [row]))
        else:
            n = int(compare_rows)
            known = (name, "row_count_parity", None, None, n, None) if parity else (name, compare_label, None, n, None, None)
            out = out.unionByName(_literal_rows(df.sparkSession, [known]))
    return out


def dq_report(silver: Mapping[str, DataFrame | None], bronze: Mapping[str, DataFrame | int | None],
              keys: Mapping[str, Sequence[str]] = POST_DQ_KEYS, hashes: int = 2,
              by: Mapping[str, Sequence[str]] | None = None) -> DataFrame:
    """Post-transform report over the silver tables (bronze counts informational).

    ``bronze``: bronze tables, or their row counts when already known.
    ``hashes``, ``by`` (by table): see ``distinct_rows``.
    """
    present = {n: silver[n] for n in keys if silver.get(n) is not None}
    if not present:
        raise DataQualityError("no silver dataset to check")
    spark = next(iter(present.values())).sparkSession
    out = _literal_rows(spark, [(n, "present", None, None, None, False) for n in keys if n not in present])
    for name, df in present.items():
        out = out.unionByName(dataset_checks(name, df, keys[name], bronze.get(name), hashes=hashes, by=(by or {}).get(name, ())))
    return out


def dq_rows(silver: Mapping[str, DataFrame | None], bronze: Mapping[str, DataFrame | int | None],
            keys: Mapping[str, Sequence[str]] = POST_DQ_KEYS, by: Mapping[str, Sequence[str]] | None = None) -> list[tuple]:
    """The rows of ``dq_report`` over stored tables, with half its shuffle where no table has copies: one hash of each
    row shows that, and only tables in which it finds copies are grouped by two."""
    rows = [tuple(r) for r in dq_report(silver, bronze, keys, 1, by).collect()]
    suspects = {name for name, check, _, value, *_ in rows if check == "duplicate_rows" and value}
    if not suspects:
        return rows
    again = dq_report(silver, bronze, {n: k for n, k in keys.items() if n in suspects}, by=by).collect()
    exact = {tuple(r)[:3]: tuple(r) for r in again}
    return [exact.get(r[:3], r) for r in rows]


def raw_vs_bronze(name: str, raw: DataFrame, bronze: DataFrame, required: Sequence[str]) -> DataFrame:
    """Pre-transform checks: row and column count parity, required nulls, duplicates."""
    raw_cols, bronze_cols = len(_data(raw).columns), len(_data(bronze).columns)
    # Two scalar counts side by side: union the one-row aggregates, then pivot
    # them with a conditional aggregate (no join).
    counts = (_data(raw).agg(F.count(F.lit(1)).alias("n")).withColumn("side", F.lit("raw"))
              .unionByName(_data(bronze).agg(F.count(F.lit(1)).alias("n"))
                           .withColumn("side", F.lit("bronze")))
              .agg(F.max(F.when(F.col("side") == "bronze", F.col("n"))).alias("value"),
                   F.max(F.when(F.col("side") == "raw", F.col("n"))).alias("expected")))
    row_parity = _rows(counts, [_row_sql(name, "row_count", None, "value", "expected", "value = expected")])
    col_parity = _literal_rows(raw.sparkSession, [(name, "column_count", None, bronze_cols, raw_cols,
                                                   bronze_cols == raw_cols)])
    checks = dataset_checks(name, bronze, [c for c in required if c in _data(bronze).columns])
    checks = checks.where(F.col("check").isin("null_count", "duplicate_rows"))
    return row_parity.unionByName(col_parity).unionByName(checks)


def gate(report: DataFrame | list) -> None:
    """Raise ``DataQualityError`` listing the failed checks, if any.

    ``report``: the report DataFrame, or its rows already collected.
    """
    if isinstance(report, DataFrame):
        failed = report.where(~F.coalesce(F.col("passed"), F.lit(True))).collect()
    else:
        failed = [r for r in report if r.passed is False]
    if failed:
        lines = [f"{r.dataset}: {r.check}{' ' + r.column_name if r.column_name else ''}"
                 f" = {r.value}" for r in failed]
        raise DataQualityError("data quality failed: " + "; ".join(lines))


def _totals(parts: Mapping[str, DataFrame], key: str) -> DataFrame:
    """Per key the exact sum of each part (columns ``key``, ``amount``): one union and one grouping, no joins."""
    tagged = [df.select(F.col(key), money("amount").alias("amount"), F.lit(name).alias("part")) for name, df in parts.items()]
    zero = F.lit(0).cast(DecimalType(MONEY_PRECISION, MONEY_SCALE))
    return reduce(DataFrame.unionByName, tagged).groupBy(key).agg(
        *[F.coalesce(F.sum(F.when(F.col("part") == name, F.col("amount"))), zero).alias(name) for name in parts])


def reconcile_sales(invoicing: DataFrame, fct: DataFrame, cols: BillingColumns = COLS) -> DataFrame:
    """Per subscription: invoiced total vs gold sales total; difference should be 0."""
    sub = cols.subscription_id
    both = _totals({"raw": invoicing.select(sub, F.col(cols.invoice_amount).alias("amount")),
                    "gold": fct.select(sub, F.col("sales_amount").alias("amount"))}, sub)
    return both.select(F.col(sub), F.col("raw").cast("double").alias("raw_sales"), F.col("gold").cast("double").alias("gold_sales"),
                       (F.col("raw") - F.col("gold")).cast("double").alias("difference"))


def reconcile_costs(costs: DataFrame, fct: DataFrame, invoicing: DataFrame,
                    cols: BillingColumns = COLS) -> DataFrame:
    """Per subscription: silver cost total = gold cost total + orphan cost total.

    Every silver cost lands either in a gold month (a month with sales) or in
    an orphan month; ``difference`` should be 0.
    """
    sub = cols.subscription_id
    t = _totals({"silver": costs.select(sub, F.col(cols.cost_amount).alias("amount")),
                 "gold": fct.select(sub, F.col("cost_amount").alias("amount")),
                 "orphan": orphan_costs(costs, invoicing, cols).select(sub, F.col("cost_amount").alias("amount"))}, sub)
    return t.select(F.col(sub), *[F.col(c).cast("double").alias(f"{c}_cost") for c in ("silver", "gold", "orphan")],
                    (F.col("silver") - F.col("gold") - F.col("orphan")).cast("double").alias("difference"))


def orphan_costs(costs: DataFrame, invoicing: DataFrame, cols: BillingColumns = COLS) -> DataFrame:
    """Cost months with no invoice in that month (they drop out of the profit fact)."""
    from billow.plans.marts import MONTH_KEYS, month_text, monthly_sum
    sub = cols.subscription_id
    cost_by = monthly_sum(costs, sub, cols.cost_month, cols.cost_amount, "cost_amount", True)
    sales_keys = monthly_sum(invoicing, sub, cols.invoice_start, cols.invoice_amount, "s", False)
    orphans = cost_by.join(sales_keys.select(sub, *MONTH_KEYS), [sub, *MONTH_KEYS], "left_anti")
    return orphans.select(F.col(sub), month_text(), "cost_amount")


__all__ = ["DataQualityError", "REPORT_SCHEMA", "dataset_checks", "dq_report", "dq_rows", "gate",
           "orphan_costs", "raw_vs_bronze", "reconcile_sales"]
