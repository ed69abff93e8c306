"""Gold dimensions and facts.

Plan shape of ``fct_profitability``: both monthly sums group on
``(subscription_id, month start, month missing)`` with a partial aggregate
before the shuffle; the left join then reuses that hash partitioning, so
sales, costs and join together cost one exchange per side and none for the
join.  A null month is carried as a placeholder date plus a "missing" flag, so
null matches null with a plain equi-join (exactly: the flag tells the
placeholder from a real date).  The ``yyyy-MM`` text is formatted after the
aggregation, once per group instead of once per row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from billow.functions.dates import dayfirst_date, lenient_date, month_period
from billow.functions.money import money_sum
from billow.functions.text import churn_flag
from billow.operators.dedup import keep_first
from billow.spec import COLS, ORDINAL, BillingColumns

MONTH_KEY = "__month_start"
MONTH_MISSING = "__month_missing"
MONTH_KEYS = [MONTH_KEY, MONTH_MISSING]
_PLACEHOLDER_MONTH = "1970-01-01"


def _drop_ordinal(df: DataFrame) -> DataFrame:
    return df.drop(ORDINAL) if ORDINAL in df.columns else df


def _first_per(df: DataFrame, key: str) -> DataFrame:
    order = [ORDINAL] if ORDINAL in df.columns else []
    return _drop_ordinal(keep_first(df, [key], order))


def dim_customer(customers: DataFrame, cols: BillingColumns = COLS) -> DataFrame:
    """One row per customer: the first in source order."""
    return _first_per(customers, cols.customer_id)


def dim_subscription(subscriptions: DataFrame, cols: BillingColumns = COLS) -> DataFrame:
    """One row per subscription: the first enriched row, i.e. its first-seen sale type."""
    return _first_per(subscriptions, cols.subscription_id)


def fct_sales(invoicing: DataFrame) -> DataFrame:
    """Silver invoicing as it is."""
    return _drop_ordinal(invoicing)


def _as_date(df: DataFrame, col: str, dayfirst: bool) -> F.Column:
    if dict(df.dtypes)[col] == "string":
        return dayfirst_date(col) if dayfirst else lenient_date(col)
    return F.to_date(F.col(col))


def monthly_sum(df: DataFrame, key: str, date_col: str, amount: str, out: str,
                dayfirst: bool) -> DataFrame:
    """Exact sum of ``amount`` per ``key`` and calendar month of ``date_col``.

    Grouped on ``(key, month start, month missing)``; a null month is its own
    group.  Use ``month_text()`` to turn the month keys into ``yyyy-MM``.
    """
    start = F.trunc(_as_date(df, date_col, dayfirst), "MM")
    return (df.select(F.col(key),
                      F.coalesce(start, F.lit(_PLACEHOLDER_MONTH).cast("date")).alias(MONTH_KEY),
                      start.isNull().alias(MONTH_MISSING), F.col(amount))
              .groupBy(key, *MONTH_KEYS).agg(money_sum(amount).alias(out)))


def month_text() -> F.Column:
    """``yyyy-MM`` of the month keys; null for the missing-month group."""
    return F.when(~F.col(MONTH_MISSING), month_period(MONTH_KEY)).alias("month")


def profitability_schema(df: DataFrame, cols: BillingColumns = COLS) -> StructType:
    key_type = dict((f.name, f.dataType) for f in df.schema.fields).get(cols.subscription_id, StringType())
    return StructType([StructField(cols.subscription_id, key_type), StructField("month", StringType()),
                       StructField("sales_amount", DoubleType()), StructField("cost_amount", DoubleType()),
                       StructField("profit", DoubleType())])


def fct_profitability(invoicing: DataFrame, costs: DataFrame | None,
                      cols: BillingColumns = COLS, partitions: int | None = None) -> DataFrame:
    """Monthly sales, cost and profit per subscription.

    ``partitions``: hash-partitioned in so many by subscription, before the columns that follow from others are made.
    Every sales month is kept (left join); a month without cost has cost 0.0;
    costs in a month without sales are not in the fact (see quality.orphan_costs).
    Missing invoice columns give an empty typed table; missing costs give cost 0.0.
    """
    sub = cols.subscription_id
    if cols.invoice_start not in invoicing.columns or cols.invoice_amount not in invoicing.columns:
        return invoicing.sparkSession.createDataFrame([], profitability_schema(invoicing, cols))
    sales = monthly_sum(invoicing, sub, cols.invoice_start, cols.invoice_amount, "sales_amount", False)
    if costs is not None and cols.cost_month in costs.columns and cols.cost_amount in costs.columns:
        cost_by = monthly_sum(costs, sub, cols.cost_month, cols.cost_amount, "cost_amount", True)
        joined = sales.join(cost_by, [sub, *MONTH_KEYS], "left")
    else:
        joined = sales.withColumn("cost_amount", F.lit(None).cast("double"))
    cost = F.coalesce(F.col("cost_amount"), F.lit(0.0)).alias("cost_amount")
    joined = joined.select(sub, *MONTH_KEYS, F.col("sales_amount").cast("double").alias("sales_amount"), cost)
    if partitions:
        joined = joined.repartition(partitions, sub)
    return joined.select(F.col(sub), month_text(), "sales_amount", "cost_amount",
                         (F.col("sales_amount") - F.col("cost_amount")).alias("profit"))


def profit_flag(fct: DataFrame) -> DataFrame:
    """``profit_made`` = Yes when profit > 0, else No (off in the reference's run)."""
    return fct.withColumn("profit_made", F.when(F.col("profit") > 0, "Yes").otherwise("No"))


def fct_churn(subscriptions: DataFrame, cols: BillingColumns = COLS) -> DataFrame:
    """``(subscription_id, is_churned)`` per silver subscription row."""
    have = set(subscriptions.columns)
    flag = churn_flag(cols.status if cols.status in have else None,
                      cols.cancelled_at if cols.cancelled_at in have else None)
    return subscriptions.select(F.col(cols.subscription_id), flag)
