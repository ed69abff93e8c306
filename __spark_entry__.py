"""

Each query runs the library on billing-shaped role views of the test tables
(``billow.sources.roles``) over whole tables.  The oracle writes the same
role rules in SQL.  Money is summed exactly (decimal) on both sides.
"""

from __future__ import annotations

import os
import sys
from collections.abc import Callable

# importable from any working directory (the package sits next to this file)
_HERE = os.path.dirname(os.path.abspath(__file__))
if _HERE not in sys.path:
    sys.path.insert(0, _HERE)

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (DoubleType, IntegerType, LongType, StringType, StructField,
                               StructType, TimestampType)

from billow.functions import dayfirst_date, month_period, sale_type
from billow.operators import dedup, nulls
from billow.plans import analytics, clean, enrich, marts, quality
from billow.plans.pipeline import run_pipeline
from billow.session import freed_shuffles, scratch_path
from billow.sources import csv as csvsrc
from billow.sources import layers, roles
from billow.spec import ORDINAL, billing_schemas, billing_specs

SF0001 = "/root/testdata/sf0.001"
LOOKUP_ID = 7

SPECS = billing_specs()
CUSTOMER_SCHEMA = StructType([StructField("customer_id", LongType()), StructField("c_name", StringType()),
                              StructField("c_nationkey", IntegerType()), StructField("c_acctbal", DoubleType()),
                              StructField("c_mktsegment", StringType())])
RAW_SCHEMAS = {
    "customers": CUSTOMER_SCHEMA,
    "subscriptions": StructType([StructField("subscription_id", LongType()), StructField("Customer", LongType()),
                                 StructField("cancelled_at", TimestampType()), StructField("amount", DoubleType())]),
    "invoicing": StructType([StructField("subscription_id", LongType()), StructField("line_no", IntegerType()),
                             StructField("part_id", LongType()), StructField("calculated_cost", DoubleType())]),
    "costs": StructType([StructField("subscription_id", LongType()), StructField("Cost", DoubleType())]),
    "sales_tags": StructType([StructField("subscription_id", LongType())]),
}
COST_SCHEMA = StructType([StructField("subscription_id", LongType()), StructField("month", StringType()),
                          StructField("Cost", DoubleType())])


def _data(df: DataFrame) -> DataFrame:
    return df.drop(ORDINAL) if ORDINAL in df.columns else df


# -- shared Spark building blocks --------------------------------------------
def _silver_costs(spark, d):
    return clean.clean_dataset(roles.costs_raw(spark, d), SPECS["costs"])


def _silver_subscriptions(spark, d):
    subs = clean.clean_dataset(roles.subscriptions_raw(spark, d), SPECS["subscriptions"])
    return enrich.enrich_subscriptions(subs, roles.sales_tags(spark, d))


def _silver_customers(spark, d):
    return clean.clean_dataset(roles.customers_with_copies(spark, d), SPECS["customers"])


def _silver_invoicing(spark, d):
    return clean.clean_dataset(roles.invoices_raw(spark, d), SPECS["invoicing"])


def _fct_profitability(spark, d):
    costs = dedup.keep_last(roles.costs(spark, d), ["subscription_id", "month"])
    return marts.fct_profitability(roles.invoices(spark, d), costs)


def _lineitem_with_copies(spark, d):
    li = roles.table(spark, d, "lineitem")
    return li.unionByName(li.where(F.col("l_linenumber") == 1))


def _write_roles_as_raw(spark, d, raw):
    """Role tables -> raw CSV files named like the billing exports.

    File order matters only inside a keep-first / keep-last group, so only
    the datasets with such groups are sorted, on (group key, row order).  The
    sort range-partitions, so a hot key is split over several part files, whose
    names follow the ranges; a hash partition on the key would put a hot key
    in one task.
    """
    exports = {"Customers.csv": roles.customers_with_copies(spark, d).orderBy("customer_id", ORDINAL),
               "Subscriptions.csv": roles.subscriptions_raw(spark, d), "Invoicing.csv": roles.invoices_raw(spark, d),
               "Costs.csv": roles.costs_export(spark, d), "Sales tags.csv": roles.sales_tags_export(spark, d)}
    with freed_shuffles(spark):
        layers.run_concurrently({f: (lambda f=f, df=df: csvsrc.write_csv(df, f"{raw}/{f}", compression="gzip"))
                                 for f, df in exports.items()})


# -- queries -------------------------------------------------------------------
def q_ingest_roundtrip(spark, d):
    root = scratch_path(spark, "ingest")
    csvsrc.write_csv(roles.customers(spark, d), f"{root}/raw/Customers.csv")
    layers.ingest(spark, f"{root}/raw", f"{root}/bronze", {"customers": CUSTOMER_SCHEMA})
    return _data(spark.read.parquet(f"{root}/bronze/customers"))


_LOSS_COLS = "dataset string, measure string, column_name string, value long"


def q_ingest_losses(spark, d):
    """Line items as a billing export with quoted line breaks, amounts that are no numbers and records with an
    extra field: what bronze holds and what was counted as lost."""
    root = scratch_path(spark, "losses")
    li = roles.table(spark, d, "lineitem")
    note = F.when(F.col("l_suppkey") % 20 == 0, F.lit('"two\nlines, ""quoted"""')).when(F.col("l_suppkey") % 20 == 1, F.lit('5" pipe')).otherwise(F.col("l_returnflag"))
    amount = F.when(F.col("l_partkey") % 50 == 0, F.lit('"1,234.50"')).when(F.col("l_partkey") % 50 == 1, F.lit("NA")).otherwise(F.col("l_quantity").cast("string"))
    extra = F.when(F.col("l_orderkey") % 40 == 3, F.lit(",EXTRA")).otherwise(F.lit(""))
    record = F.concat_ws(",", F.col("l_orderkey").cast("string"), note, amount)
    first = F.expr("monotonically_increasing_id() & 8589934591 = 0")  # the header stands before the first record of each file
    lines = li.select(F.concat(F.when(first, F.lit("subscription_id,note,calculated_cost\n")).otherwise(F.lit("")), record, extra).alias("value"))
    lines.write.text(f"{root}/raw/Invoicing.csv")
    done = layers.ingest(spark, f"{root}/raw", f"{root}/bronze", billing_schemas())["invoicing"]
    bronze = spark.read.parquet(f"{root}/bronze/invoicing")
    counted = spark.createDataFrame([("invoicing", "rows", None, done.rows), ("invoicing", "malformed_rows", None, done.malformed),
                                     *[("invoicing", "lost_values", c, n) for c, n in done.losses.items()]], _LOSS_COLS)
    kept = bronze.agg(F.count_if(F.col("note") == 'two\nlines, "quoted"').alias("b"), F.count_if(F.col("note") == '5" pipe').alias("p"),
                      F.count("calculated_cost").alias("c"), F.sum(F.col("calculated_cost").cast("decimal(20,2)")).cast("long").alias("s"))
    kept = kept.select(F.expr("""inline(array(
        named_struct('dataset', 'invoicing', 'measure', 'notes_with_break', 'column_name', 'note', 'value', b),
        named_struct('dataset', 'invoicing', 'measure', 'notes_with_plain_quote', 'column_name', 'note', 'value', p),
        named_struct('dataset', 'invoicing', 'measure', 'amounts', 'column_name', 'calculated_cost', 'value', c),
        named_struct('dataset', 'invoicing', 'measure', 'whole_total', 'column_name', 'calculated_cost', 'value', s)))"""))
    bad = spark.read.parquet(layers.quarantine(f"{root}/bronze", "invoicing")) if done.malformed else None
    if bad is None:
        return counted.unionByName(kept)
    return counted.unionByName(kept).unionByName(bad.agg(F.count_if(F.col("record").endswith(",EXTRA")).alias("value")).select(
        F.lit("invoicing").alias("dataset"), F.lit("quarantined_records").alias("measure"), F.lit(None).cast("string").alias("column_name"), "value"))


def _part_csv(spark, d):
    path = scratch_path(spark, "part.csv")
    csvsrc.write_csv(roles.table(spark, d, "part"), path)
    return path


def q_csv_inferred(spark, d):
    return csvsrc.read_csv_inferred(spark, _part_csv(spark, d))


def q_csv_all_strings(spark, d):
    return csvsrc.read_csv_strings(spark, _part_csv(spark, d))


def q_csv_folder_scan(spark, d):
    raw = scratch_path(spark, "raw")
    csvsrc.write_csv(roles.customers(spark, d), f"{raw}/Customers.csv")
    csvsrc.write_csv(roles.subscriptions(spark, d), f"{raw}/Subscription export.csv")
    parts = [csvsrc.read_csv(spark, path, with_ordinal=False)
             .agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("dataset"), "row_count")
             for name, path in csvsrc.list_csv_datasets(spark, raw).items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def q_gold_table_roundtrip(spark, d):
    root = scratch_path(spark, "gold")
    db = "gold_" + root.rstrip("/").split("/")[-2][:12]
    name = layers.save_gold_table(spark, roles.customers(spark, d), "dim_customer", db, root)
    return layers.read_gold_sql(spark, f"SELECT * FROM {name}")


def q_null_tokens(spark, d):
    tokens = F.col("customer_id") % 5
    src = roles.customers(spark, d).withColumn(
        "c_mktsegment", F.when(tokens == 0, "NA").when(tokens == 1, "N/A").when(tokens == 2, "null")
                         .when(tokens == 3, "").otherwise(F.col("c_mktsegment")))
    path = scratch_path(spark, "Customers.csv")
    csvsrc.write_csv(src, path)
    return _data(csvsrc.read_csv(spark, path, CUSTOMER_SCHEMA)).select("customer_id", "c_name", "c_mktsegment")


def q_optional_missing_cost(spark, d):
    missing = scratch_path(spark, "raw", "Costs.csv")
    costs = csvsrc.read_optional(spark, missing, COST_SCHEMA)
    return marts.fct_profitability(roles.invoices(spark, d), costs)


def q_project_rename(spark, d):
    o = roles.table(spark, d, "orders")
    return o.select(F.col("o_orderkey").alias("subscription_id"), F.col("o_custkey").alias("Customer"),
                    F.col("o_orderstatus").alias("status"))


def q_date_columns_by_pattern(spark, d):
    o = roles.table(spark, d, "orders")
    key = F.col("o_orderkey")
    src = o.select(
        key.alias("subscription_id"),
        F.when(key % 50 == 0, F.lit("bad"))
         .when(key % 2 == 0, F.concat(F.date_format("o_orderdate", "yyyy-MM-dd"), F.lit(" 12:34:56.789")))
         .otherwise(F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss")).alias("created_at"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("Start_Date"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("end_text"))
    return clean.parse_dates(src, SPECS["invoicing"])


def q_select_all_dynamic(spark, d):
    view = "customers_" + scratch_path(spark).rstrip("/").split("/")[-1][:12]
    roles.customers(spark, d).withColumnRenamed("c_mktsegment", "market segment").createOrReplaceTempView(view)
    cols = ", ".join(f"`{c}`" for c in spark.table(view).columns)
    return spark.sql(f"SELECT {cols} FROM `{view}`")


def q_required_not_null(spark, d):
    return _data(nulls.require_not_null(roles.subscriptions_raw(spark, d), SPECS["subscriptions"].required))


def q_clean_costs(spark, d):
    return _data(_silver_costs(spark, d))


def q_dropped_rows_report(spark, d):
    return clean.dropped_rows_report(roles.costs_raw(spark, d), SPECS["costs"]).unionByName(
        clean.dropped_rows_report(roles.subscriptions_raw(spark, d), SPECS["subscriptions"]))


def q_null_counts(spark, d):
    return nulls.null_counts(_data(roles.costs_raw(spark, d)))


def q_point_lookup_sorted(spark, d):
    return analytics.point_lookup(roles.invoices(spark, d), "subscription_id", LOOKUP_ID,
                                  ["start", "line_no", "part_id"])


def q_like_counts(spark, d):
    return analytics.like_counts(roles.subscriptions_raw(spark, d))


def q_status_domain(spark, d):
    return analytics.value_domain(roles.subscriptions_raw(spark, d), "status")


def q_month_period(spark, d):
    inv = roles.invoices_null_month(spark, d)
    return inv.select("subscription_id", "start", month_period("start").alias("month"))


def q_dayfirst_dates(spark, d):
    o = roles.table(spark, d, "orders")
    text = roles.date_text("o_orderdate", "o_orderkey")
    return o.select(F.col("o_orderkey").alias("subscription_id"), text.alias("order_date_text"),
                    dayfirst_date(text).alias("order_date"))


def q_sale_type(spark, d):
    t = roles.sales_tags(spark, d)
    return t.select("subscription_id", "tag", sale_type("tag").alias("sale_type"))


def q_sale_type_pairs(spark, d):
    return _data(enrich.sale_type_pairs(roles.sales_tags(spark, d)))


def q_subscription_enriched(spark, d):
    return _data(_silver_subscriptions(spark, d))


def q_keep_last_cost(spark, d):
    return _data(dedup.keep_last(roles.costs(spark, d), ["subscription_id", "month"]))


def q_dim_subscription(spark, d):
    return marts.dim_subscription(_silver_subscriptions(spark, d))


def q_dim_customer(spark, d):
    return marts.dim_customer(roles.customers_with_copies(spark, d))


def q_drop_row_duplicates(spark, d):
    return dedup.drop_row_duplicates(_lineitem_with_copies(spark, d), exclude=())


def q_row_duplicate_count(spark, d):
    return dedup.row_duplicate_count(_lineitem_with_copies(spark, d), exclude=())


def q_duplicate_listing(spark, d):
    groups = dedup.duplicate_groups(_lineitem_with_copies(spark, d), exclude=())
    # most groups have two rows: the row's columns break ties and let the range partitioner split them
    return groups.orderBy(F.col("duplicate_count").desc(), *[c for c in groups.columns if c != "duplicate_count"])


def q_cost_duplicate_groups(spark, d):
    return dedup.duplicate_groups(roles.costs_raw(spark, d), ["subscription_id", "month", "Cost"], count_name="cnt")


def q_sales_by_month(spark, d):
    s = marts.monthly_sum(roles.invoices_null_month(spark, d), "subscription_id", "start",
                          "calculated_cost", "sales_amount", False)
    return s.select("subscription_id", marts.month_text(), "sales_amount")


def q_cost_by_month(spark, d):
    s = marts.monthly_sum(_silver_costs(spark, d), "subscription_id", "month", "Cost", "cost_amount", True)
    return s.select("subscription_id", marts.month_text(), "cost_amount")


def q_fct_sales(spark, d):
    return marts.fct_sales(_silver_invoicing(spark, d))


def q_fct_profitability(spark, d):
    return _fct_profitability(spark, d)


def q_profit_flag(spark, d):
    return marts.profit_flag(_fct_profitability(spark, d))


def q_fct_churn(spark, d):
    return marts.fct_churn(_silver_subscriptions(spark, d))


def q_churn_summary(spark, d):
    return analytics.churn_summary(marts.fct_churn(_silver_subscriptions(spark, d)))


def q_churn_partition_check(spark, d):
    return analytics.churn_partition_check(marts.fct_churn(_silver_subscriptions(spark, d)))


def q_churn_fanout(spark, d):
    return analytics.churn_fanout(marts.fct_churn(_silver_subscriptions(spark, d)))


def q_monthly_profit(spark, d):
    return analytics.monthly_profit(_fct_profitability(spark, d))


def q_top_customers(spark, d):
    dim_sub = marts.dim_subscription(_silver_subscriptions(spark, d))
    dim_cust = marts.dim_customer(roles.customers_with_copies(spark, d))
    return analytics.top_customers(_fct_profitability(spark, d), dim_sub, dim_cust, k=5)


def q_sample_profitability(spark, d):
    view = "fct_profitability_" + scratch_path(spark).rstrip("/").split("/")[-1][:12]
    _fct_profitability(spark, d).createOrReplaceTempView(view)
    return analytics.sample_rows(spark, view, ["subscription_id", "month", "sales_amount", "cost_amount", "profit"],
                                 ["subscription_id", "month"], 10)


def q_dq_parity(spark, d):
    root = scratch_path(spark, "dq")
    csvsrc.write_csv(roles.invoices_raw(spark, d), f"{root}/raw/Invoicing.csv")
    layers.ingest(spark, f"{root}/raw", f"{root}/bronze", RAW_SCHEMAS)
    raw = csvsrc.read_csv(spark, f"{root}/raw/Invoicing.csv", RAW_SCHEMAS["invoicing"], with_ordinal=False)
    bronze = spark.read.parquet(f"{root}/bronze/invoicing")
    return quality.raw_vs_bronze("invoicing", raw, bronze, SPECS["invoicing"].required)


def q_dq_report(spark, d):
    silver = {"customers": _silver_customers(spark, d), "subscriptions": _silver_subscriptions(spark, d),
              "invoicing": _silver_invoicing(spark, d), "costs": _silver_costs(spark, d)}
    bronze = {"customers": roles.customers_with_copies(spark, d), "subscriptions": roles.subscriptions_raw(spark, d),
              "invoicing": roles.invoices_raw(spark, d), "costs": roles.costs_raw(spark, d)}
    return quality.dq_report(silver, bronze)


def q_pipeline_profitability(spark, d):
    root = scratch_path(spark, "run")
    run = layers.Layers(root)
    _write_roles_as_raw(spark, d, run.raw)
    db = "gold_" + root.rstrip("/").split("/")[-2][:12]
    result = run_pipeline(spark, run, RAW_SCHEMAS, database=db, keep_raw=False)
    return spark.sql(f"SELECT subscription_id, month, sales_amount, cost_amount, profit "
                     f"FROM {result.gold['fct_profitability']}")


def q_orphan_costs(spark, d):
    costs = dedup.keep_last(roles.costs(spark, d), ["subscription_id", "month"])
    return quality.orphan_costs(costs, roles.invoices_not_returned(spark, d))


def q_reconcile_costs(spark, d):
    costs = dedup.keep_last(roles.costs(spark, d), ["subscription_id", "month"])
    inv = roles.invoices_not_returned(spark, d)
    return quality.reconcile_costs(costs, marts.fct_profitability(inv, costs), inv)


def q_sale_type_domain(spark, d):
    return analytics.value_domain(marts.dim_subscription(_silver_subscriptions(spark, d)), "sale_type",
                                  drop_null=False)


def _gold_run(spark, d):
    """Gold database of one pipeline run over the role tables."""
    root = scratch_path(spark, "gold_run")
    run = layers.Layers(root)
    _write_roles_as_raw(spark, d, run.raw)
    db = "gold_" + root.rstrip("/").split("/")[-2][:12]
    run_pipeline(spark, run, RAW_SCHEMAS, database=db, keep_raw=False)
    return db


def q_gold_sql_monthly_profit(spark, d):
    return analytics.gold_question(spark, "monthly_profit", _gold_run(spark, d))


def q_gold_sql_churn_summary(spark, d):
    return analytics.gold_question(spark, "churn_summary", _gold_run(spark, d))


def q_gold_sql_top_customers(spark, d):
    return analytics.gold_question(spark, "top_customers", _gold_run(spark, d))


def q_reconcile_sales(spark, d):
    return quality.reconcile_sales(roles.invoices(spark, d), _fct_profitability(spark, d))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "ingest_roundtrip": q_ingest_roundtrip,
    "ingest_losses": q_ingest_losses,
    "csv_inferred": q_csv_inferred,
    "csv_all_strings": q_csv_all_strings,
    "csv_folder_scan": q_csv_folder_scan,
    "gold_table_roundtrip": q_gold_table_roundtrip,
    "null_tokens": q_null_tokens,
    "optional_missing_cost": q_optional_missing_cost,
    "project_rename": q_project_rename,
    "date_columns_by_pattern": q_date_columns_by_pattern,
    "select_all_dynamic": q_select_all_dynamic,
    "required_not_null": q_required_not_null,
    "clean_costs": q_clean_costs,
    "dropped_rows_report": q_dropped_rows_report,
    "null_counts": q_null_counts,
    "point_lookup_sorted": q_point_lookup_sorted,
    "like_counts": q_like_counts,
    "status_domain": q_status_domain,
    "month_period": q_month_period,
    "dayfirst_dates": q_dayfirst_dates,
    "sale_type": q_sale_type,
    "sale_type_pairs": q_sale_type_pairs,
    "subscription_enriched": q_subscription_enriched,
    "keep_last_cost": q_keep_last_cost,
    "dim_subscription": q_dim_subscription,
    "dim_customer": q_dim_customer,
    "drop_row_duplicates": q_drop_row_duplicates,
    "row_duplicate_count": q_row_duplicate_count,
    "duplicate_listing": q_duplicate_listing,
    "cost_duplicate_groups": q_cost_duplicate_groups,
    "sales_by_month": q_sales_by_month,
    "cost_by_month": q_cost_by_month,
    "fct_sales": q_fct_sales,
    "fct_profitability": q_fct_profitability,
    "profit_flag": q_profit_flag,
    "fct_churn": q_fct_churn,
    "churn_summary": q_churn_summary,
    "churn_partition_check": q_churn_partition_check,
    "churn_fanout": q_churn_fanout,
    "monthly_profit": q_monthly_profit,
    "top_customers": q_top_customers,
    "sample_profitability": q_sample_profitability,
    "dq_parity": q_dq_parity,
    "dq_report": q_dq_report,
    "pipeline_profitability": q_pipeline_profitability,
    "orphan_costs": q_orphan_costs,
    "reconcile_sales": q_reconcile_sales,
    "reconcile_costs": q_reconcile_costs,
    "sale_type_domain": q_sale_type_domain,
    "gold_sql_monthly_profit": q_gold_sql_monthly_profit,
    "gold_sql_churn_summary": q_gold_sql_churn_summary,
    "gold_sql_top_customers": q_gold_sql_top_customers,
}


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: monthly profitability per subscription on sf0.001."""
    return q_fct_profitability(spark, SF0001)


try:
    import corpus_pipeline as _pipeline
    from billow.llm import queries as _llm
except ImportError:
    _pipeline = _llm = None  # the training-data subpackage, or a library of it, is not installed


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return QUERIES | ({**_llm.QUERIES, "pipeline": _pipeline.run} if _llm else {})


# -- oracle (DuckDB SQL) ----------------------------------------------------------
_STATUS = ("CASE o_orderstatus WHEN 'F' THEN 'SUBSCRIPTION_STATUS_CANCELLED' "
           "WHEN 'O' THEN 'SUBSCRIPTION_STATUS_ACTIVATED' WHEN 'P' THEN 'SUBSCRIPTION_STATUS_PENDING' END")
_LINE_ORDER_DESC = "l_shipdate DESC, l_linenumber DESC, l_partkey DESC, l_suppkey DESC, l_extendedprice DESC"
_LINE_ORDER_ASC = "l_shipdate, l_linenumber, l_partkey, l_suppkey, l_extendedprice"
_LI_COLS = ("l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, "
            "l_tax, l_returnflag, l_linestatus, l_shipdate")

_PROFIT_SELECT_P = ("SELECT s.subscription_id, s.month, CAST(s.s AS DOUBLE) AS sales_amount, "
                    "COALESCE(CAST(c.c AS DOUBLE), 0.0) AS cost_amount, "
                    "CAST(s.s AS DOUBLE) - COALESCE(CAST(c.c AS DOUBLE), 0.0) AS profit "
                    "FROM p_sales_m s LEFT JOIN p_costs_m c ON s.subscription_id = c.subscription_id "
                    "AND s.month IS NOT DISTINCT FROM c.month")

CTES = {
    "cust": "SELECT c_custkey AS customer_id, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer",
    "cust_src": ("SELECT c_custkey AS customer_id, c_name, c_nationkey, c_acctbal, c_mktsegment, 1 AS copy_no "
                 "FROM customer UNION ALL SELECT c_custkey, c_name || ' (old)', c_nationkey, c_acctbal, "
                 "c_mktsegment, 0 FROM customer WHERE c_nationkey = 3"),
    "sub_base": (f"SELECT CASE WHEN o_orderkey % 100 <> 99 THEN o_orderkey END AS subscription_id, "
                 f"o_custkey AS Customer, CASE WHEN o_orderkey % 10 <> 0 THEN {_STATUS} END AS status, "
                 f"CASE WHEN o_orderpriority = '1-URGENT' THEN o_orderdate END AS cancelled_at, "
                 f"o_orderpriority AS plan, o_totalprice AS amount, "
                 f"(o_orderpriority = '2-HIGH' AND o_orderstatus = 'O') AS dup FROM orders"),
    "sub_raw": ("SELECT subscription_id, Customer, status, cancelled_at, plan, amount FROM sub_base "
                "UNION ALL SELECT subscription_id, Customer, status, cancelled_at, plan, amount "
                "FROM sub_base WHERE dup"),
    "sub_clean": ("SELECT DISTINCT * FROM sub_raw "
                  "WHERE subscription_id IS NOT NULL AND Customer IS NOT NULL"),
    "tags": ("SELECT l_orderkey AS subscription_id, CASE WHEN p_size % 10 = 0 THEN p_type "
             "WHEN p_size = 1 THEN ':' || p_brand WHEN p_size % 10 = 5 THEN lower(p_type) || ':' || p_brand "
             f"ELSE p_type || ':' || p_brand END AS tag, {_LINE_ORDER_ASC} "
             "FROM lineitem JOIN part ON l_partkey = p_partkey"),
    "pairs": "SELECT DISTINCT subscription_id, upper(split_part(tag, ':', 1)) AS sale_type FROM tags",
    "first_tag": ("SELECT subscription_id, upper(split_part(tag, ':', 1)) AS sale_type FROM tags "
                  f"QUALIFY row_number() OVER (PARTITION BY subscription_id ORDER BY {_LINE_ORDER_ASC}) = 1"),
    "enriched": "SELECT s.*, p.sale_type FROM sub_clean s LEFT JOIN pairs p USING (subscription_id)",
    "dim_sub": "SELECT s.*, t.sale_type FROM sub_clean s LEFT JOIN first_tag t USING (subscription_id)",
    "dim_cust": ("SELECT customer_id, c_name, c_nationkey, c_acctbal, c_mktsegment FROM cust_src "
                 "QUALIFY row_number() OVER (PARTITION BY customer_id ORDER BY copy_no) = 1"),
    "churn": ("SELECT subscription_id, (COALESCE(regexp_matches(lower(status), 'cancel|terminate|churn'), false) "
              "OR cancelled_at IS NOT NULL) AS is_churned FROM enriched"),
    "inv": ("SELECT l_orderkey AS subscription_id, l_linenumber AS line_no, l_partkey AS part_id, "
            "l_extendedprice AS calculated_cost, l_shipdate AS start FROM lineitem"),
    "inv_nm": ("SELECT l_orderkey AS subscription_id, CASE WHEN l_discount <> 0.0 THEN l_extendedprice END "
               "AS calculated_cost, CASE WHEN l_linenumber <> 7 THEN l_shipdate END AS start FROM lineitem"),
    "inv_base": ("SELECT l_orderkey AS subscription_id, l_linenumber AS line_no, l_partkey AS part_id, "
                 "l_extendedprice AS calculated_cost, strftime(l_shipdate, '%Y-%m-%d') AS start, "
                 "strftime(last_day(l_shipdate), '%Y-%m-%d') AS \"end\", "
                 "CASE WHEN l_linenumber = 7 THEN 'bad' WHEN l_linenumber % 2 = 0 "
                 "THEN strftime(l_shipdate, '%Y-%m-%d') || ' 10:30:00.5' "
                 "ELSE strftime(l_shipdate, '%Y-%m-%d') || ' 23:59:59' END AS created_at FROM lineitem"),
    "inv_raw": "SELECT * FROM inv_base UNION ALL SELECT * FROM inv_base WHERE line_no = 1",
    "inv_silver": ("SELECT DISTINCT subscription_id, line_no, part_id, calculated_cost, "
                   "CAST(TRY_CAST(start AS TIMESTAMP) AS DATE) AS start, \"end\", "
                   "CAST(TRY_CAST(created_at AS TIMESTAMP) AS DATE) AS created_at FROM inv_raw "
                   "WHERE subscription_id IS NOT NULL"),
    "cost": ("SELECT l_orderkey AS subscription_id, CAST(date_trunc('month', l_shipdate) AS DATE) AS month, "
             f"l_extendedprice AS Cost, {_LINE_ORDER_ASC} FROM lineitem WHERE l_returnflag = 'R'"),
    "cost_last": ("SELECT subscription_id, month, Cost FROM cost QUALIFY row_number() OVER "
                  f"(PARTITION BY subscription_id, month ORDER BY {_LINE_ORDER_DESC}) = 1"),
    "cost_base": ("SELECT CASE WHEN l_orderkey % 10 <> 0 THEN l_orderkey END AS subscription_id, "
                  "CASE WHEN l_linenumber = 7 THEN 'bad' WHEN l_orderkey % 2 = 0 "
                  "THEN strftime(l_shipdate, '%Y-%m') || '-01' ELSE '01/' || strftime(l_shipdate, '%m/%Y') END "
                  f"AS month, l_extendedprice AS Cost, {_LINE_ORDER_ASC}, 0 AS copy_no "
                  "FROM lineitem WHERE l_returnflag = 'R'"),
    "cost_raw": ("SELECT * FROM cost_base UNION ALL SELECT * REPLACE (1 AS copy_no) FROM cost_base "
                 "WHERE l_linenumber = 1"),
    "cost_parsed": ("SELECT * REPLACE (CAST(COALESCE(TRY_STRPTIME(month, '%Y-%m-%d'), "
                    "TRY_STRPTIME(month, '%d/%m/%Y')) AS DATE) AS month) FROM cost_raw"),
    "cost_kept": ("SELECT subscription_id, month, Cost FROM cost_parsed QUALIFY row_number() OVER "
                  f"(PARTITION BY subscription_id, month ORDER BY {_LINE_ORDER_DESC}, copy_no DESC) = 1"),
    "cost_silver": "SELECT DISTINCT * FROM cost_kept WHERE subscription_id IS NOT NULL",
    "sales_m": ("SELECT subscription_id, strftime(start, '%Y-%m') AS month, "
                "SUM(CAST(calculated_cost AS DECIMAL(38,9))) AS s FROM inv GROUP BY ALL"),
    "costs_m": ("SELECT subscription_id, strftime(month, '%Y-%m') AS month, "
                "SUM(CAST(Cost AS DECIMAL(38,9))) AS c FROM cost_last GROUP BY ALL"),
    "fct": ("SELECT s.subscription_id, s.month, CAST(s.s AS DOUBLE) AS sales_amount, "
            "COALESCE(CAST(c.c AS DOUBLE), 0.0) AS cost_amount, "
            "CAST(s.s AS DOUBLE) - COALESCE(CAST(c.c AS DOUBLE), 0.0) AS profit "
            "FROM sales_m s LEFT JOIN costs_m c ON s.subscription_id = c.subscription_id "
            "AND s.month IS NOT DISTINCT FROM c.month"),
    "li_dup": f"SELECT {_LI_COLS} FROM lineitem UNION ALL SELECT {_LI_COLS} FROM lineitem WHERE l_linenumber = 1",
    "p_sales_m": ("SELECT subscription_id, strftime(start, '%Y-%m') AS month, "
                  "SUM(CAST(calculated_cost AS DECIMAL(38,9))) AS s FROM inv_silver GROUP BY ALL"),
    "p_costs_m": ("SELECT subscription_id, strftime(month, '%Y-%m') AS month, "
                  "SUM(CAST(Cost AS DECIMAL(38,9))) AS c FROM cost_silver GROUP BY ALL"),
    "inv_nr": ("SELECT l_orderkey AS subscription_id, l_extendedprice AS calculated_cost, l_shipdate AS start "
               "FROM lineitem WHERE l_returnflag <> 'R'"),
    "nr_sales_m": ("SELECT subscription_id, strftime(start, '%Y-%m') AS month, "
                   "SUM(CAST(calculated_cost AS DECIMAL(38,9))) AS s FROM inv_nr GROUP BY ALL"),
    "nr_fct": ("SELECT s.subscription_id, s.month, COALESCE(c.c, 0) AS c FROM nr_sales_m s LEFT JOIN costs_m c "
               "ON s.subscription_id = c.subscription_id AND s.month IS NOT DISTINCT FROM c.month"),
    "nr_orphan": ("SELECT c.subscription_id, c.month, c.c FROM costs_m c WHERE NOT EXISTS (SELECT 1 FROM "
                  "nr_sales_m s WHERE s.subscription_id = c.subscription_id AND s.month IS NOT DISTINCT FROM c.month)"),
    "p_fct": _PROFIT_SELECT_P,
    "p_churn": ("SELECT subscription_id, (COALESCE(regexp_matches(lower(status), 'cancel|terminate|churn'), false) "
                "OR cancelled_at IS NOT NULL) AS is_churned FROM enriched"),
}
_DEPS = {
    "cust_src": [], "sub_raw": ["sub_base"], "sub_clean": ["sub_raw"], "pairs": ["tags"],
    "first_tag": ["tags"], "enriched": ["sub_clean", "pairs"], "dim_sub": ["sub_clean", "first_tag"],
    "dim_cust": ["cust_src"], "churn": ["enriched"], "inv_raw": ["inv_base"], "inv_silver": ["inv_raw"],
    "cost_last": ["cost"], "cost_raw": ["cost_base"], "cost_parsed": ["cost_raw"],
    "cost_kept": ["cost_parsed"], "cost_silver": ["cost_kept"], "sales_m": ["inv"],
    "costs_m": ["cost_last"], "fct": ["sales_m", "costs_m"], "p_sales_m": ["inv_silver"],
    "p_costs_m": ["cost_silver"], "nr_sales_m": ["inv_nr"], "nr_fct": ["nr_sales_m", "costs_m"],
    "nr_orphan": ["nr_sales_m", "costs_m"], "p_fct": ["p_sales_m", "p_costs_m"], "p_churn": ["enriched"],
}


def _with(select: str, *names: str) -> str:
    order: list[str] = []

    def add(n):
        for dep in _DEPS.get(n, []):
            add(dep)
        if n not in order:
            order.append(n)
    for n in names:
        add(n)
    return "WITH " + ",\n".join(f"{n} AS ({CTES[n]})" for n in order) + "\n" + select


def _dup_total(src: str, cols: str) -> str:
    return (f"(SELECT CAST(COALESCE(SUM(cnt - 1), 0) AS BIGINT) FROM (SELECT COUNT(*) AS cnt FROM {src} "
            f"GROUP BY {cols} HAVING COUNT(*) > 1))")


def _dq_rows(ds: str, silver: str, bronze: str, keys: list[str], cols: str) -> str:
    parts = [f"SELECT '{ds}' AS dataset, 'row_count' AS \"check\", CAST(NULL AS VARCHAR) AS column_name, "
             f"COUNT(*) AS value, CAST(NULL AS BIGINT) AS expected, CAST(NULL AS BOOLEAN) AS passed FROM {silver}",
             f"SELECT '{ds}', 'not_empty', NULL, COUNT(*), NULL, COUNT(*) > 0 FROM {silver}"]
    for k in keys:
        parts.append(f"SELECT '{ds}', 'null_count', '{k}', COUNT(*) FILTER (WHERE {k} IS NULL), 0, "
                     f"COUNT(*) FILTER (WHERE {k} IS NULL) = 0 FROM {silver}")
    dup = _dup_total(silver, cols)
    parts.append(f"SELECT '{ds}', 'duplicate_rows', NULL, {dup}, 0, {dup} = 0")
    parts.append(f"SELECT '{ds}', 'bronze_rows', NULL, COUNT(*), NULL, NULL FROM {bronze}")
    return "\nUNION ALL ".join(parts)


ORACLE = {
    "ingest_roundtrip": CTES["cust"],
    "ingest_losses": """WITH r AS (SELECT *, l_orderkey % 40 = 3 AS extra FROM lineitem), g AS (SELECT * FROM r WHERE NOT extra)
        SELECT 'invoicing' AS dataset, 'rows' AS measure, CAST(NULL AS VARCHAR) AS column_name, count(*) AS value FROM g
        UNION ALL SELECT 'invoicing', 'malformed_rows', NULL, count(*) FROM r WHERE extra
        UNION ALL SELECT 'invoicing', 'lost_values', 'calculated_cost', count(*) FROM g WHERE l_partkey % 50 = 0
        UNION ALL SELECT 'invoicing', 'notes_with_break', 'note', count(*) FROM g WHERE l_suppkey % 20 = 0
        UNION ALL SELECT 'invoicing', 'notes_with_plain_quote', 'note', count(*) FROM g WHERE l_suppkey % 20 = 1
        UNION ALL SELECT 'invoicing', 'amounts', 'calculated_cost', count(*) FROM g WHERE l_partkey % 50 > 1
        UNION ALL SELECT 'invoicing', 'whole_total', 'calculated_cost', CAST(sum(l_quantity) AS BIGINT) FROM g WHERE l_partkey % 50 > 1
        UNION ALL SELECT 'invoicing', 'quarantined_records', NULL, count(*) FROM r WHERE extra""",
    "csv_inferred": ("SELECT CAST(p_partkey AS INTEGER) AS p_partkey, p_name, p_brand, p_type, p_size, "
                     "p_retailprice FROM part"),
    "csv_all_strings": ("SELECT CAST(p_partkey AS VARCHAR) AS p_partkey, p_name, p_brand, p_type, "
                        "CAST(p_size AS VARCHAR) AS p_size, CAST(p_retailprice AS VARCHAR) AS p_retailprice FROM part"),
    "csv_folder_scan": ("SELECT 'customers' AS dataset, COUNT(*) AS row_count FROM customer "
                        "UNION ALL SELECT 'subscription_export', COUNT(*) FROM orders"),
    "gold_table_roundtrip": CTES["cust"],
    "null_tokens": ("SELECT c_custkey AS customer_id, c_name, CASE WHEN c_custkey % 5 = 4 THEN c_mktsegment END "
                    "AS c_mktsegment FROM customer"),
    "optional_missing_cost": _with(
        "SELECT subscription_id, month, CAST(s AS DOUBLE) AS sales_amount, CAST(0.0 AS DOUBLE) AS cost_amount, "
        "CAST(s AS DOUBLE) AS profit FROM sales_m", "sales_m"),
    "project_rename": ("SELECT o_orderkey AS subscription_id, o_custkey AS Customer, o_orderstatus AS status "
                       "FROM orders"),
    "date_columns_by_pattern": (
        "SELECT o_orderkey AS subscription_id, CAST(TRY_CAST(CASE WHEN o_orderkey % 50 = 0 THEN 'bad' "
        "WHEN o_orderkey % 2 = 0 THEN strftime(o_orderdate, '%Y-%m-%d') || ' 12:34:56.789' "
        "ELSE strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') END AS TIMESTAMP) AS DATE) AS created_at, "
        "CAST(o_orderdate AS DATE) AS Start_Date, strftime(o_orderdate, '%Y-%m-%d') AS end_text FROM orders"),
    "select_all_dynamic": ("SELECT c_custkey AS customer_id, c_name, c_nationkey, c_acctbal, "
                           "c_mktsegment AS \"market segment\" FROM customer"),
    "required_not_null": _with("SELECT * FROM sub_raw WHERE subscription_id IS NOT NULL AND Customer IS NOT NULL",
                               "sub_raw"),
    "clean_costs": _with("SELECT * FROM cost_silver", "cost_silver"),
    "dropped_rows_report": _with(
        "SELECT 'costs' AS dataset, 'keep_last' AS step, n0 AS rows_before, n1 AS rows_after, "
        "n0 - n1 AS rows_dropped FROM k "
        "UNION ALL SELECT 'costs', 'not_null:subscription_id', n1, n2, n1 - n2 FROM k "
        "UNION ALL SELECT 'costs', 'dedupe', n2, n3, n2 - n3 FROM k "
        "UNION ALL SELECT 'subscriptions', 'not_null:subscription_id', m0, m1, m0 - m1 FROM m "
        "UNION ALL SELECT 'subscriptions', 'not_null:Customer', m1, m2, m1 - m2 FROM m "
        "UNION ALL SELECT 'subscriptions', 'dedupe', m2, m3, m2 - m3 FROM m",
        "cost_silver", "sub_clean").replace(
        "\nSELECT 'costs'",
        ",\nk AS (SELECT (SELECT COUNT(*) FROM cost_raw) AS n0, "
        "(SELECT COUNT(*) FROM (SELECT DISTINCT subscription_id, month FROM cost_parsed)) AS n1, "
        "(SELECT COUNT(*) FROM (SELECT DISTINCT subscription_id, month FROM cost_parsed "
        "WHERE subscription_id IS NOT NULL)) AS n2, (SELECT COUNT(*) FROM cost_silver) AS n3),\n"
        "m AS (SELECT (SELECT COUNT(*) FROM sub_raw) AS m0, "
        "(SELECT COUNT(*) FROM sub_raw WHERE subscription_id IS NOT NULL) AS m1, "
        "(SELECT COUNT(*) FROM sub_raw WHERE subscription_id IS NOT NULL AND Customer IS NOT NULL) AS m2, "
        "(SELECT COUNT(*) FROM sub_clean) AS m3)\nSELECT 'costs'", 1),
    "null_counts": _with(
        "SELECT 'subscription_id' AS column_name, COUNT(*) FILTER (WHERE subscription_id IS NULL) AS null_count "
        "FROM cost_raw UNION ALL SELECT 'month', COUNT(*) FILTER (WHERE month IS NULL) FROM cost_raw "
        "UNION ALL SELECT 'Cost', COUNT(*) FILTER (WHERE Cost IS NULL) FROM cost_raw", "cost_raw"),
    "point_lookup_sorted": _with(f"SELECT * FROM inv WHERE subscription_id = {LOOKUP_ID} "
                                 "ORDER BY start, line_no, part_id", "inv"),
    "like_counts": _with(
        "SELECT COUNT(*) AS total_cnt, COUNT(*) FILTER (WHERE status IS NOT NULL) AS non_null_status_cnt, "
        "COUNT(*) FILTER (WHERE status LIKE '%CANCELLED%') AS is_churned_cnt, "
        "COUNT(*) FILTER (WHERE status NOT LIKE '%CANCELLED%') AS is_not_churned_cnt FROM sub_raw", "sub_raw"),
    "status_domain": _with("SELECT DISTINCT status FROM sub_raw WHERE status IS NOT NULL", "sub_raw"),
    "month_period": _with("SELECT subscription_id, start, strftime(start, '%Y-%m') AS month FROM inv_nm", "inv_nm"),
    "dayfirst_dates": (
        "SELECT subscription_id, order_date_text, CAST(COALESCE(TRY_STRPTIME(order_date_text, '%Y-%m-%d'), "
        "TRY_STRPTIME(order_date_text, '%d/%m/%Y')) AS DATE) AS order_date FROM (SELECT o_orderkey AS "
        "subscription_id, CASE WHEN o_orderkey % 50 = 0 THEN 'bad' WHEN o_orderkey % 2 = 0 "
        "THEN strftime(o_orderdate, '%Y-%m-%d') ELSE strftime(o_orderdate, '%d/%m/%Y') END AS order_date_text "
        "FROM orders)"),
    "sale_type": _with("SELECT subscription_id, tag, upper(split_part(tag, ':', 1)) AS sale_type FROM tags",
                       "tags"),
    "sale_type_pairs": _with("SELECT * FROM pairs", "pairs"),
    "subscription_enriched": _with("SELECT * FROM enriched", "enriched"),
    "keep_last_cost": _with("SELECT * FROM cost_last", "cost_last"),
    "dim_subscription": _with("SELECT * FROM dim_sub", "dim_sub"),
    "dim_customer": _with("SELECT * FROM dim_cust", "dim_cust"),
    "drop_row_duplicates": _with("SELECT DISTINCT * FROM li_dup", "li_dup"),
    "row_duplicate_count": _with(f"SELECT {_dup_total('li_dup', _LI_COLS)} AS duplicate_rows", "li_dup"),
    "duplicate_listing": _with(f"SELECT {_LI_COLS}, COUNT(*) AS duplicate_count FROM li_dup "
                               f"GROUP BY {_LI_COLS} HAVING COUNT(*) > 1", "li_dup"),
    "cost_duplicate_groups": _with("SELECT subscription_id, month, Cost, COUNT(*) AS cnt FROM cost_raw "
                                   "GROUP BY subscription_id, month, Cost HAVING COUNT(*) > 1", "cost_raw"),
    "sales_by_month": _with(
        "SELECT subscription_id, strftime(start, '%Y-%m') AS month, "
        "COALESCE(CAST(SUM(CAST(calculated_cost AS DECIMAL(38,9))) AS DOUBLE), 0.0) AS sales_amount "
        "FROM inv_nm GROUP BY ALL", "inv_nm"),
    "cost_by_month": _with(
        "SELECT subscription_id, strftime(month, '%Y-%m') AS month, "
        "COALESCE(CAST(SUM(CAST(Cost AS DECIMAL(38,9))) AS DOUBLE), 0.0) AS cost_amount "
        "FROM cost_silver GROUP BY ALL", "cost_silver"),
    "fct_sales": _with("SELECT * FROM inv_silver", "inv_silver"),
    "fct_profitability": _with("SELECT * FROM fct", "fct"),
    "profit_flag": _with("SELECT *, CASE WHEN profit > 0 THEN 'Yes' ELSE 'No' END AS profit_made FROM fct", "fct"),
    "fct_churn": _with("SELECT * FROM churn", "churn"),
    "churn_summary": _with("SELECT is_churned, COUNT(*) AS subs FROM churn GROUP BY is_churned", "churn"),
    "churn_partition_check": _with(
        "SELECT COUNT(*) AS total_cnt, COUNT(*) FILTER (WHERE is_churned) AS is_churned_cnt, "
        "COUNT(*) FILTER (WHERE NOT is_churned) AS is_not_churned_cnt, "
        "COUNT(*) = COUNT(*) FILTER (WHERE is_churned) + COUNT(*) FILTER (WHERE NOT is_churned) AS balanced "
        "FROM churn", "churn"),
    "churn_fanout": _with(
        "SELECT CAST(SUM(n) AS BIGINT) AS churn_rows, COUNT(*) AS subscriptions, "
        "CAST(SUM(n) - COUNT(*) AS BIGINT) AS fanout_rows, "
        "CAST(COALESCE(SUM(CASE WHEN churned THEN n END), 0) AS BIGINT) AS churned_rows, "
        "COUNT(*) FILTER (WHERE churned) AS churned_subscriptions "
        "FROM (SELECT subscription_id, COUNT(*) AS n, bool_or(is_churned) AS churned FROM churn "
        "GROUP BY subscription_id)", "churn"),
    "monthly_profit": _with(
        "SELECT subscription_id, month, CAST(ROUND(SUM(CAST(profit AS DECIMAL(38,9))), 2) AS DOUBLE) "
        "AS total_profit FROM fct GROUP BY subscription_id, month", "fct"),
    "top_customers": _with(
        "SELECT c.customer_id, CAST(ROUND(SUM(CAST(f.sales_amount AS DECIMAL(38,9))), 2) AS DOUBLE) AS total_sales "
        "FROM fct f JOIN dim_sub d ON f.subscription_id = d.subscription_id "
        "JOIN dim_cust c ON d.Customer = c.customer_id GROUP BY c.customer_id "
        "ORDER BY total_sales DESC, c.customer_id LIMIT 5", "fct", "dim_sub", "dim_cust"),
    "sample_profitability": _with("SELECT * FROM fct ORDER BY subscription_id ASC NULLS FIRST, "
                                  "month ASC NULLS FIRST LIMIT 10", "fct"),
    "dq_parity": _with(
        "SELECT 'invoicing' AS dataset, 'row_count' AS \"check\", CAST(NULL AS VARCHAR) AS column_name, "
        "COUNT(*) AS value, COUNT(*) AS expected, true AS passed FROM inv_raw "
        "UNION ALL SELECT 'invoicing', 'column_count', NULL, 7, 7, true "
        "UNION ALL SELECT 'invoicing', 'null_count', 'subscription_id', COUNT(*) FILTER "
        "(WHERE subscription_id IS NULL), 0, COUNT(*) FILTER (WHERE subscription_id IS NULL) = 0 FROM inv_raw "
        f"UNION ALL SELECT 'invoicing', 'duplicate_rows', NULL, "
        f"{_dup_total('inv_raw', 'subscription_id, line_no, part_id, calculated_cost, start, \"end\", created_at')}, 0, "
        f"{_dup_total('inv_raw', 'subscription_id, line_no, part_id, calculated_cost, start, \"end\", created_at')} = 0",
        "inv_raw"),
    "dq_report": _with(
        "\nUNION ALL ".join([
            _dq_rows("customers", "cust_silver", "cust_src", ["customer_id"],
                     "customer_id, c_name, c_nationkey, c_acctbal, c_mktsegment"),
            _dq_rows("subscriptions", "enriched", "sub_raw", ["subscription_id", "Customer"],
                     "subscription_id, Customer, status, cancelled_at, plan, amount, sale_type"),
            _dq_rows("invoicing", "inv_silver", "inv_raw", ["subscription_id"],
                     "subscription_id, line_no, part_id, calculated_cost, start, \"end\", created_at"),
            _dq_rows("costs", "cost_silver", "cost_raw", ["subscription_id"], "subscription_id, month, Cost"),
        ]), "cust_src", "enriched", "inv_silver", "cost_silver").replace(
        "\nSELECT 'customers'",
        ",\ncust_silver AS (SELECT DISTINCT customer_id, c_name, c_nationkey, c_acctbal, c_mktsegment "
        "FROM cust_src WHERE customer_id IS NOT NULL)\nSELECT 'customers'", 1),
    "pipeline_profitability": _with("SELECT * FROM p_fct", "p_fct"),
    "orphan_costs": _with(
        "SELECT c.subscription_id, c.month, CAST(c.c AS DOUBLE) AS cost_amount FROM costs_m c "
        "WHERE NOT EXISTS (SELECT 1 FROM inv_nr i WHERE i.subscription_id = c.subscription_id "
        "AND strftime(i.start, '%Y-%m') IS NOT DISTINCT FROM c.month)", "costs_m", "inv_nr"),
    "reconcile_costs": _with(
        "SELECT COALESCE(a.subscription_id, b.subscription_id, o.subscription_id) AS subscription_id, "
        "CAST(COALESCE(a.t, 0) AS DOUBLE) AS silver_cost, CAST(COALESCE(b.t, 0) AS DOUBLE) AS gold_cost, "
        "CAST(COALESCE(o.t, 0) AS DOUBLE) AS orphan_cost, "
        "CAST(COALESCE(a.t, 0) - COALESCE(b.t, 0) - COALESCE(o.t, 0) AS DOUBLE) AS difference "
        "FROM (SELECT subscription_id, SUM(CAST(Cost AS DECIMAL(38,9))) AS t FROM cost_last GROUP BY ALL) a "
        "FULL JOIN (SELECT subscription_id, SUM(CAST(CAST(c AS DOUBLE) AS DECIMAL(38,9))) AS t FROM nr_fct "
        "GROUP BY ALL) b ON a.subscription_id = b.subscription_id "
        "FULL JOIN (SELECT subscription_id, SUM(CAST(CAST(c AS DOUBLE) AS DECIMAL(38,9))) AS t FROM nr_orphan "
        "GROUP BY ALL) o ON COALESCE(a.subscription_id, b.subscription_id) = o.subscription_id",
        "cost_last", "nr_fct", "nr_orphan"),
    "sale_type_domain": _with("SELECT DISTINCT sale_type FROM dim_sub", "dim_sub"),
    "gold_sql_monthly_profit": _with("SELECT subscription_id, month, ROUND(SUM(profit), 2) AS total_profit "
                                     "FROM p_fct GROUP BY subscription_id, month", "p_fct"),
    "gold_sql_churn_summary": _with("SELECT is_churned, COUNT(*) AS subs FROM p_churn GROUP BY is_churned",
                                    "p_churn"),
    "gold_sql_top_customers": _with(
        "SELECT c.customer_id, ROUND(SUM(f.sales_amount), 2) AS total_sales FROM p_fct f "
        "JOIN dim_sub d ON f.subscription_id = d.subscription_id JOIN dim_cust c ON d.Customer = c.customer_id "
        "GROUP BY c.customer_id ORDER BY total_sales DESC, c.customer_id LIMIT 5", "p_fct", "dim_sub", "dim_cust"),
    "reconcile_sales": _with(
        "SELECT COALESCE(r.subscription_id, g.subscription_id) AS subscription_id, "
        "CAST(COALESCE(r.t, 0) AS DOUBLE) AS raw_sales, CAST(COALESCE(g.t, 0) AS DOUBLE) AS gold_sales, "
        "CAST(COALESCE(r.t, 0) - COALESCE(g.t, 0) AS DOUBLE) AS difference "
        "FROM (SELECT subscription_id, SUM(CAST(calculated_cost AS DECIMAL(38,9))) AS t FROM inv GROUP BY ALL) r "
        "FULL JOIN (SELECT subscription_id, SUM(CAST(sales_amount AS DECIMAL(38,9))) AS t FROM fct GROUP BY ALL) g "
        "ON r.subscription_id = g.subscription_id", "inv", "fct"),
}


def oracle_sql() -> dict[str, str]:
    more = {**_llm.ORACLE, "pipeline": _pipeline.ORACLE_SQL} if _llm else {}
    return ORACLE | {k: v for k, v in more.items() if v}
