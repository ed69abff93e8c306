"""Physical-plan shape: shuffles, partial aggregation, pushdown.

These are the properties that matter at scale; the row results are checked
elsewhere.  Broadcast joins are switched off here so the exchange counts do
not depend on how small the test tables are.
"""

import contextlib
import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as e
from billow.operators import dedup
from billow.plans import clean, quality
from billow.sources import roles
from billow.spec import billing_specs

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df.sparkSession._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


@contextlib.contextmanager
def no_broadcast(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        yield
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def hash_exchanges(df) -> int:
    text = df.sparkSession._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "simple")
    return text.count("Exchange hashpartitioning")


def test_profitability_three_exchanges_join_reuses_partitioning(spark):
    with no_broadcast(spark):
        df = e.q_fct_profitability(spark, SF)
        text = df.sparkSession._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "simple")
    # sales sum: 1, cost keep-last: 1, cost sum: 1; the join adds none
    assert text.count("Exchange hashpartitioning") == 3, text
    assert "SortMergeJoin" in text


def simple(df) -> str:
    return df.sparkSession._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "simple")


def test_keep_last_is_partially_aggregated_before_shuffle(spark):
    df = dedup.keep_last(roles.costs(spark, SF), ["subscription_id", "month"])
    lines = simple(df).splitlines()
    ex = [i for i, line in enumerate(lines) if "Exchange hashpartitioning" in line]
    partial = [i for i, line in enumerate(lines) if "partial_max" in line]
    final = [i for i, line in enumerate(lines) if "Aggregate" in line and "partial_" not in line]
    # the tree prints top-down: final aggregate, then the exchange, then the partial aggregate
    assert len(ex) == 1 and partial and final
    assert final[0] < ex[0] < partial[0]


def test_cleaning_is_one_shuffle(spark):
    for name, raw in (("costs", roles.costs_raw), ("subscriptions", roles.subscriptions_raw)):
        df = clean.clean_dataset(raw(spark, SF), billing_specs()[name])
        assert hash_exchanges(df) == 1, name
        report = clean.dropped_rows_report(raw(spark, SF), billing_specs()[name])
        assert hash_exchanges(report) == 1, name


def test_quality_checks_one_grouping(spark):
    df = quality.dataset_checks("costs", roles.costs_raw(spark, SF), ["subscription_id"])
    # hashes and counts move, never the rows
    assert hash_exchanges(df) == 1
    assert re.search(r"hashpartitioning\(__h1#\d+L?, __h2#\d+L?", plan(df)), plan(df)


def test_filters_and_columns_reach_the_scan(spark):
    text = plan(e.q_point_lookup_sorted(spark, SF))
    assert re.search(r"PushedFilters: \[IsNotNull\(l_orderkey\), EqualTo\(l_orderkey,7\)\]", text), text
    cost_scan = plan(roles.costs(spark, SF))
    assert "EqualTo(l_returnflag,R)" in cost_scan
    read_schema = re.search(r"ReadSchema: (struct<[^>]*>)", cost_scan).group(1)
    assert "l_tax" not in read_schema and "l_discount" not in read_schema


def test_top_customers_is_top_k_not_full_sort(spark):
    text = plan(e.q_top_customers(spark, SF))
    assert "TakeOrderedAndProject" in text
    assert "LeftSemi" in text


@pytest.mark.parametrize("hot_share", [3])
def test_hot_key_keep_last_correct(spark, hot_share):
    n = 90000
    df = spark.range(n).select(
        F.when(F.col("id") % hot_share == 0, F.lit(0)).otherwise(F.col("id")).alias("k"),
        F.col("id").alias("ord"), (F.col("id") * 2).alias("v")).repartition(8)
    kept = dedup.keep_last(df, ["k"], ["ord"])
    assert kept.count() == n - n // hot_share + 1
    hot = kept.where("k = 0").first()
    assert hot.ord == n - hot_share and hot.v == 2 * (n - hot_share)
    assert "partial_max" in plan(kept)


def test_gold_fact_dimension_join_is_bucketed(spark):
    with no_broadcast(spark):
        df = e.q_gold_sql_top_customers(spark, SF)
        text = simple(df)
    # fact and subscriptions stay put; the joined rows move, re-keyed by customer, and at this size (one bucket) the customers
    assert text.count("Bucketed: true") >= 2
    assert text.count("Exchange hashpartitioning") <= 2
    assert df.count() == 5


@contextlib.contextmanager
def confs(spark, **settings):
    old = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_hot_subscription_join_is_split_by_aqe(spark):
    """A subscription holding a third of all rows: AQE splits its join partition."""
    from billow.plans.enrich import enrich_subscriptions
    n = 60000
    subs = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).alias("subscription_id"),
        F.lit("C").alias("Customer"), F.col("id").cast("string").alias("status"))
    tags = spark.range(n).select((F.col("id") % 1000).alias("subscription_id"),
                                 F.concat(F.lit("t"), (F.col("id") % 3).cast("string"), F.lit(":x")).alias("tag"))
    # thresholds scaled down to the test size (defaults: 256 MB, factor 5)
    with confs(spark, **{"spark.sql.autoBroadcastJoinThreshold": "-1",
                         "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
                         "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
                         "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
                         "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k",
                         "spark.sql.adaptive.coalescePartitions.enabled": "false"}):
        out = enrich_subscriptions(subs, tags)
        rows = out.collect()
        final = simple(out)
    hot = [r for r in rows if r.subscription_id == 0]
    assert len(hot) == (n // 3) * 3                # every hot row x its 3 sale types
    assert "SortMergeJoin(skew=true)" in final, final
