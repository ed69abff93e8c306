"""Billing-shaped role views over the TPC-H-ish test tables.

subscription = ``orders``, customer = ``customer``, invoice = ``lineitem``,
cost = ``lineitem`` with return flag R, sales tag = ``lineitem`` joined to
``part``.  The base tables have no nulls and no duplicate rows, so the raw
roles derive them: null keys, unparsable dates, whole-row copies and mixed
date formats, each from a rule on the row itself.  The DuckDB oracle writes
the same rules in SQL.

``_row_order`` stands in for file order: lines are ordered by ship date,
line number, part, supplier, price (and copy number), which is unique within
an order.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from billow.spec import ORDINAL

LINE_ORDER = ("l_shipdate", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")
STATUS_BY_ORDER_STATUS = {
    "F": "SUBSCRIPTION_STATUS_CANCELLED",
    "O": "SUBSCRIPTION_STATUS_ACTIVATED",
    "P": "SUBSCRIPTION_STATUS_PENDING",
}


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d.rstrip('/')}/{name}.parquet")


def _line_order(copy: Column | None = None) -> Column:
    fields = [F.col(c) for c in LINE_ORDER]
    if copy is not None:
        fields.append(copy.alias("copy_no"))
    return F.struct(*fields).alias(ORDINAL)


def _with_copies(df: DataFrame, copies: DataFrame, order: Callable[[Column], Column]) -> DataFrame:
    return df.select("*", order(F.lit(0))).unionByName(copies.select("*", order(F.lit(1))))


# -- customers ---------------------------------------------------------------
def customers(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "customer").select(
        F.col("c_custkey").alias("customer_id"), "c_name", "c_nationkey", "c_acctbal", "c_mktsegment")


def customers_with_copies(spark: SparkSession, d: str) -> DataFrame:
    """Customers of nation 3 appear twice; the renamed copy comes first in order."""
    base = customers(spark, d)
    copies = base.where(F.col("c_nationkey") == 3).withColumn(
        "c_name", F.concat(F.col("c_name"), F.lit(" (old)")))
    order = lambda n: F.struct(n.alias("copy_no"), F.col("customer_id")).alias(ORDINAL)
    return base.select("*", order(F.lit(1))).unionByName(copies.select("*", order(F.lit(0))))


# -- subscriptions -----------------------------------------------------------
def status_text(order_status: Column) -> Column:
    (code, text), *rest = STATUS_BY_ORDER_STATUS.items()
    expr = F.when(order_status == code, F.lit(text))
    for code, text in rest:
        expr = expr.when(order_status == code, F.lit(text))
    return expr


def subscriptions(spark: SparkSession, d: str) -> DataFrame:
    """One row per order, no derived nulls or copies."""
    o = table(spark, d, "orders")
    return o.select(F.col("o_orderkey").alias("subscription_id"), F.col("o_custkey").alias("Customer"),
                    status_text(F.col("o_orderstatus")).alias("status"),
                    F.when(F.col("o_orderpriority") == "1-URGENT", F.col("o_orderdate")).alias("cancelled_at"),
                    F.col("o_orderpriority").alias("plan"), F.col("o_totalprice").alias("amount"))


def subscriptions_raw(spark: SparkSession, d: str) -> DataFrame:
    """Null id where key % 100 = 99, null status where key % 10 = 0,
    and whole-row copies of the 2-HIGH open orders."""
    o = table(spark, d, "orders")
    key = F.col("o_orderkey")
    rows = o.select(
        F.when(key % 100 != 99, key).alias("subscription_id"),
        F.col("o_custkey").alias("Customer"),
        F.when(key % 10 != 0, status_text(F.col("o_orderstatus"))).alias("status"),
        F.when(F.col("o_orderpriority") == "1-URGENT", F.col("o_orderdate")).alias("cancelled_at"),
        F.col("o_orderpriority").alias("plan"), F.col("o_totalprice").alias("amount"),
        key.alias("__k"),
        ((F.col("o_orderpriority") == "2-HIGH") & (F.col("o_orderstatus") == "O")).alias("__dup"))
    order = lambda n: F.struct(F.col("__k").alias("key"), n.alias("copy_no")).alias(ORDINAL)
    out = _with_copies(rows, rows.where("__dup"), order)
    return out.drop("__k", "__dup")


# -- sales tags --------------------------------------------------------------
def tag_text(p_type: Column, p_brand: Column, p_size: Column) -> Column:
    return (F.when(p_size % 10 == 0, p_type)
             .when(p_size == 1, F.concat(F.lit(":"), p_brand))
             .when(p_size % 10 == 5, F.concat(F.lower(p_type), F.lit(":"), p_brand))
             .otherwise(F.concat(p_type, F.lit(":"), p_brand)))


def sales_tags(spark: SparkSession, d: str) -> DataFrame:
    li = table(spark, d, "lineitem")
    p = table(spark, d, "part")
    j = li.join(p, li.l_partkey == p.p_partkey, "inner")
    return j.select(F.col("l_orderkey").alias("subscription_id"),
                    tag_text(F.col("p_type"), F.col("p_brand"), F.col("p_size")).alias("tag"),
                    _line_order())


# -- invoices ----------------------------------------------------------------
def invoices(spark: SparkSession, d: str) -> DataFrame:
    li = table(spark, d, "lineitem")
    return li.select(F.col("l_orderkey").alias("subscription_id"), F.col("l_linenumber").alias("line_no"),
                     F.col("l_partkey").alias("part_id"), F.col("l_extendedprice").alias("calculated_cost"),
                     F.col("l_shipdate").alias("start"))


def invoices_not_returned(spark: SparkSession, d: str) -> DataFrame:
    """Invoices of the lines that are not returned (the cost role's complement)."""
    li = table(spark, d, "lineitem").where(F.col("l_returnflag") != "R")
    return li.select(F.col("l_orderkey").alias("subscription_id"),
                     F.col("l_extendedprice").alias("calculated_cost"), F.col("l_shipdate").alias("start"))


def invoices_null_month(spark: SparkSession, d: str) -> DataFrame:
    """No start date on line 7, no amount where the discount is 0."""
    li = table(spark, d, "lineitem")
    return li.select(F.col("l_orderkey").alias("subscription_id"),
                     F.when(F.col("l_discount") != 0.0, F.col("l_extendedprice")).alias("calculated_cost"),
                     F.when(F.col("l_linenumber") != 7, F.col("l_shipdate")).alias("start"))


def _day(c: str) -> Column:
    return F.date_format(F.col(c), "yyyy-MM-dd")


def invoices_raw(spark: SparkSession, d: str) -> DataFrame:
    """Text dates (created_at with and without fraction, bad on line 7) and
    whole-row copies of line 1."""
    li = table(spark, d, "lineitem")
    rows = li.select(
        F.col("l_orderkey").alias("subscription_id"), F.col("l_linenumber").alias("line_no"),
        F.col("l_partkey").alias("part_id"), F.col("l_extendedprice").alias("calculated_cost"),
        _day("l_shipdate").alias("start"),
        F.date_format(F.last_day(F.col("l_shipdate")), "yyyy-MM-dd").alias("end"),
        F.when(F.col("l_linenumber") == 7, F.lit("bad"))
         .when(F.col("l_linenumber") % 2 == 0, F.concat(_day("l_shipdate"), F.lit(" 10:30:00.5")))
         .otherwise(F.concat(_day("l_shipdate"), F.lit(" 23:59:59"))).alias("created_at"),
        *LINE_ORDER)
    out = _with_copies(rows, rows.where(F.col("l_linenumber") == 1), _line_order)
    return out.select("subscription_id", "line_no", "part_id", "calculated_cost", "start", "end",
                      "created_at", ORDINAL)


# -- costs -------------------------------------------------------------------
def costs(spark: SparkSession, d: str) -> DataFrame:
    """Returned lines; month = first day of the ship month."""
    li = table(spark, d, "lineitem").where(F.col("l_returnflag") == "R")
    return li.select(F.col("l_orderkey").alias("subscription_id"),
                     F.trunc(F.to_date("l_shipdate"), "MM").alias("month"),
                     F.col("l_extendedprice").alias("Cost"), _line_order())


def cost_month_text(shipdate: str, orderkey: str, linenumber: str) -> Column:
    ym = F.date_format(F.col(shipdate), "yyyy-MM")
    dmy = F.date_format(F.col(shipdate), "MM/yyyy")
    return (F.when(F.col(linenumber) == 7, F.lit("bad"))
             .when(F.col(orderkey) % 2 == 0, F.concat(ym, F.lit("-01")))
             .otherwise(F.concat(F.lit("01/"), dmy)))


def _cost_key() -> Column:
    return F.when(F.col("l_orderkey") % 10 != 0, F.col("l_orderkey"))


def costs_raw(spark: SparkSession, d: str) -> DataFrame:
    """Null id where key % 10 = 0, month as ISO (even keys) or dd/MM/yyyy (odd)
    text, 'bad' on line 7, and whole-row copies of line 1."""
    li = table(spark, d, "lineitem").where(F.col("l_returnflag") == "R")
    rows = li.select(
        _cost_key().alias("subscription_id"),
        cost_month_text("l_shipdate", "l_orderkey", "l_linenumber").alias("month"),
        F.col("l_extendedprice").alias("Cost"), *LINE_ORDER)
    out = _with_copies(rows, rows.where(F.col("l_linenumber") == 1), _line_order)
    return out.select("subscription_id", "month", "Cost", ORDINAL)


# -- exports in row order ------------------------------------------------------
# The rows of a role as its raw file has them, ordered by (subscription, row order) and without the ordinal.  Only what
# orders the lines is moved: texts that follow from it are made after the sort, and so are copies, which stand beside their line.
def costs_export(spark: SparkSession, d: str) -> DataFrame:
    """``costs_raw`` in row order."""
    key = _cost_key()
    li = table(spark, d, "lineitem").where(F.col("l_returnflag") == "R").select("l_orderkey", *LINE_ORDER)
    copies = F.when(F.col("l_linenumber") == 1, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return li.orderBy(key, *LINE_ORDER).select(
        key.alias("subscription_id"), cost_month_text("l_shipdate", "l_orderkey", "l_linenumber").alias("month"),
        F.col("l_extendedprice").alias("Cost"), F.explode(copies).alias("copy_no")).drop("copy_no")


def sales_tags_export(spark: SparkSession, d: str) -> DataFrame:
    """``sales_tags`` in row order.  Supplier and price are left out of the order: lines equal in all before them have
    one part and so the same tags."""
    order = [c for c in LINE_ORDER if c not in ("l_suppkey", "l_extendedprice")]
    li = table(spark, d, "lineitem").select("l_orderkey", *order)
    tags = table(spark, d, "part").select("p_partkey", tag_text(F.col("p_type"), F.col("p_brand"), F.col("p_size")).alias("tag"))
    j = li.join(tags, li.l_partkey == tags.p_partkey, "inner").select("l_orderkey", "tag", *order)
    return j.orderBy("l_orderkey", *order).select(F.col("l_orderkey").alias("subscription_id"), "tag")


def date_text(ts: str, key: str) -> Column:
    """ISO for even keys, dd/MM/yyyy for odd keys, 'bad' where key % 50 = 0."""
    return (F.when(F.col(key) % 50 == 0, F.lit("bad"))
             .when(F.col(key) % 2 == 0, F.date_format(F.col(ts), "yyyy-MM-dd"))
             .otherwise(F.date_format(F.col(ts), "dd/MM/yyyy")))
