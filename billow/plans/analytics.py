"""Business queries over gold, and lookups over raw/silver tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from billow.functions.money import money, round_money
from billow.operators.aggregate import group_count
from billow.operators.joins import semi_join
from billow.spec import COLS, BillingColumns


# A business question asked of the gold tables in SQL ({db} = gold database).
# The names of the result columns are fixed values; money is summed per subscription before any join.
TOP_CUSTOMERS_SQL = """
    WITH sold AS (
        SELECT subscription_id, SUM(sales_amount) AS amount FROM {db}.fct_profitability GROUP BY subscription_id),
    by_customer AS (
        SELECT owned.Customer AS customer_id, SUM(sold.amount) AS amount
        FROM sold INNER JOIN {db}.dim_subscription AS owned USING (subscription_id)
        GROUP BY owned.Customer)
    SELECT customer_id, ROUND(amount, 2) AS total_sales
    FROM by_customer LEFT SEMI JOIN {db}.dim_customer USING (customer_id)
    ORDER BY total_sales DESC, customer_id
    LIMIT 5"""


def gold_question(spark, name: str, database: str = "gold") -> DataFrame:
    """One of the business questions over the gold tables: the library's own queries where it has them."""
    if name == "monthly_profit":
        return monthly_profit(spark.table(f"`{database}`.fct_profitability"))
    if name == "churn_summary":
        return churn_summary(spark.table(f"`{database}`.fct_churn"))
    if name == "top_customers":
        return spark.sql(TOP_CUSTOMERS_SQL.format(db=f"`{database}`"))
    raise KeyError(name)


def monthly_profit(fct: DataFrame, cols: BillingColumns = COLS) -> DataFrame:
    """Profit per subscription and month, rounded to 2 (half-up on the exact sum)."""
    return (fct.groupBy(cols.subscription_id, "month")
               .agg(round_money(F.sum(money("profit"))).alias("total_profit")))


def churn_summary(fct_churn: DataFrame) -> DataFrame:
    """Number of subscription rows per churn flag."""
    return group_count(fct_churn, ["is_churned"], "subs")


def churn_partition_check(fct_churn: DataFrame) -> DataFrame:
    """churned + not churned = total, from one pass."""
    return fct_churn.agg(
        F.count(F.lit(1)).alias("total_cnt"),
        F.count_if(F.col("is_churned")).alias("is_churned_cnt"),
        F.count_if(~F.col("is_churned")).alias("is_not_churned_cnt"),
    ).withColumn("balanced", F.col("total_cnt") == F.col("is_churned_cnt") + F.col("is_not_churned_cnt"))


def churn_fanout(fct_churn: DataFrame, cols: BillingColumns = COLS) -> DataFrame:
    """How much the sale-type fan-out inflates the churn fact.

    A subscription with several sale types has one churn row per type.  Rows
    are first counted per subscription (partial aggregation before the
    shuffle), then totalled: rows, distinct subscriptions, the extra rows, and
    churn counted both ways.
    """
    per_sub = fct_churn.groupBy(cols.subscription_id).agg(
        F.count(F.lit(1)).alias("n"), F.max("is_churned").alias("churned"))
    return per_sub.agg(
        F.sum("n").alias("churn_rows"),
        F.count(F.lit(1)).alias("subscriptions"),
        (F.sum("n") - F.count(F.lit(1))).alias("fanout_rows"),
        F.coalesce(F.sum(F.when(F.col("churned"), F.col("n"))), F.lit(0)).alias("churned_rows"),
        F.count_if(F.col("churned")).alias("churned_subscriptions"),
    )


def top_customers(fct: DataFrame, dim_sub: DataFrame, dim_cust: DataFrame, k: int = 5,
                  cols: BillingColumns = COLS) -> DataFrame:
    """Top ``k`` customers by rounded sales (ties by customer id).

    Same result as fact JOIN dim_subscription JOIN dim_customer GROUP BY
    customer, planned smaller: sales are summed per subscription before the
    join (the fact has one row per month), per customer before the customer
    join, and the customer join is a semi-join since dim_customer is unique
    on its key.  The final top-k keeps k rows per partition, never a full sort.
    """
    sub, ref, cid = cols.subscription_id, cols.customer_ref, cols.customer_id
    per_sub = fct.groupBy(sub).agg(F.sum(money("sales_amount")).alias("__s"))
    per_cust = (per_sub.join(dim_sub.select(sub, ref), [sub], "inner")
                       .groupBy(ref).agg(F.sum("__s").alias("__s")))
    ranked = semi_join(per_cust, dim_cust, ref, cid).select(
        F.col(ref).alias(cid), round_money("__s").alias("total_sales"))
    return ranked.orderBy(F.col("total_sales").desc(), F.col(cid).asc()).limit(k)


def sample_rows(spark, table: str, columns: Sequence[str], order_by: Sequence[str], n: int = 10) -> DataFrame:
    """``SELECT cols FROM table ORDER BY ... LIMIT n`` through Spark SQL (nulls first).

    ``table`` is a view name or ``database.table``.
    """
    cols = ", ".join(f"`{c}`" for c in columns)
    order = ", ".join(f"`{c}` ASC NULLS FIRST" for c in order_by)
    name = ".".join(f"`{part}`" for part in table.split("."))
    return spark.sql(f"SELECT {cols} FROM {name} ORDER BY {order} LIMIT {int(n)}")


def like_counts(subs: DataFrame, status: str = COLS.status, needle: str = "CANCELLED") -> DataFrame:
    """LIKE / NOT LIKE / IS NOT NULL counts in one pass (null is in neither LIKE count)."""
    s = F.col(status)
    pattern = f"%{needle}%"
    return subs.agg(
        F.count(F.lit(1)).alias("total_cnt"),
        F.count_if(s.isNotNull()).alias("non_null_status_cnt"),
        F.count_if(s.like(pattern)).alias("is_churned_cnt"),
        F.count_if(~s.like(pattern)).alias("is_not_churned_cnt"),
    )


def value_domain(df: DataFrame, col: str, drop_null: bool = True) -> DataFrame:
    """Distinct values of one column."""
    out = df.select(col)
    if drop_null:
        out = out.where(F.col(col).isNotNull())
    return out.distinct()


def point_lookup(df: DataFrame, col: str, value, order_by: Sequence[str]) -> DataFrame:
    """Rows of one entity, sorted (pushed down to the scan as an equality filter)."""
    return df.where(F.col(col) == F.lit(value)).orderBy(*order_by)
