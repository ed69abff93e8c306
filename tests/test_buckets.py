"""Silver tables in hash buckets of the subscription: same results as without, nothing moved twice, hot keys apart."""

import os

import pytest
from pyspark.sql import functions as F

from billow.operators import dedup
from billow.plans import marts, pipeline, quality
from billow.plans.pipeline import run_pipeline
from billow.session import FREE_SHUFFLES, setting
from billow.sources import roles
from billow.sources.csv import path_exists
from billow.sources.layers import Buckets, Layers, save_bucketed
from tests.conftest import write_csv_file

GOLD = ("dim_customer", "dim_subscription", "fct_churn", "fct_sales", "fct_profitability")


def _raw(root, subs=60):
    raw = f"{root}/raw"
    write_csv_file(f"{raw}/Customers.csv", ["customer_id", "name"], [("C1", "Ada"), ("C1", "Ada (old)"), ("C2", "Bo")])
    ids = [None if i % 7 == 0 else f"S{i % 40}" for i in range(subs)]
    write_csv_file(f"{raw}/Subscriptions.csv", ["subscription_id", "Customer", "status", "cancelled_at"],
                   [(s, f"C{i % 2 + 1}", "SUBSCRIPTION_STATUS_PAUSED" if i % 3 else None, None) for i, s in enumerate(ids)])
    write_csv_file(f"{raw}/Invoicing.csv", ["subscription_id", "calculated_cost", "start"],
                   [(s, i % 5 + 0.25, "bad" if i % 11 == 0 else f"2022-0{i % 9 + 1}-03") for i, s in enumerate(ids * 3)])
    write_csv_file(f"{raw}/Costs.csv", ["subscription_id", "month", "Cost"],
                   [(s, "bad" if i % 13 == 0 else f"01/0{i % 9 + 1}/2022", i + 0.5) for i, s in enumerate(ids * 2)])
    write_csv_file(f"{raw}/Sales tags.csv", ["subscription_id", "tag"],
                   [(s, f"type{i % 3}:{i}") for i, s in enumerate(ids * 2)])


def _found(spark, layers, result, database):
    rows = lambda df: sorted(map(repr, df.collect()))
    return {"steps": sorted(result.steps), "losses": sorted(result.losses), "dq": sorted(map(repr, result.dq.collect())),
            "silver": {n: (e.rows, rows(spark.read.parquet(layers.table("silver", n)))) for n, e in result.silver.items()},
            "gold": {n: rows(spark.table(f"{database}.{n}")) for n in GOLD}}


@pytest.mark.parametrize("subs", [60, 0])
def test_same_results_with_and_without_buckets(spark, tmp_path, monkeypatch, subs):
    found = {}
    for kind, bucket_rows, slot_rows in (("many", 50, 50), ("uneven", 1, 50)):
        layers, database = Layers(f"{tmp_path}/{kind}"), f"gold_{kind}_{subs}"
        _raw(layers.root, subs)
        monkeypatch.setattr(pipeline, "BUCKET_ROWS", bucket_rows)
        monkeypatch.setattr(pipeline, "SLOT_ROWS", slot_rows)
        result = run_pipeline(spark, layers, database=database, post_gate=False)
        found[kind] = _found(spark, layers, result, database)
        names = [f for f in os.listdir(layers.table("silver", "invoicing")) if f.endswith(".parquet")]
        assert all(("_0000" in f) == (kind == "many" and subs > 0) for f in names), names
        assert not [t.name for t in spark.catalog.listTables(database) if t.name.startswith("silver_")]
        if not subs:  # a table without rows is read by its path
            run_pipeline(spark, layers, database=database, post_gate=False, start_at="model")
            assert _found(spark, layers, result, database) == found[kind]
    assert found["many"] == found["uneven"]


def test_a_hot_subscription_is_not_bucketed(spark, tmp_path, monkeypatch):
    layers = Layers(str(tmp_path))
    _raw(layers.root)
    run_pipeline(spark, layers, database="gold_hot", post_gate=False)
    _, bronze = pipeline.verified(spark, layers.root, "bronze")
    specs = pipeline.billing_specs()
    buckets = lambda: pipeline._silver_buckets(spark, layers, bronze, specs, pipeline.COLS, "gold_hot", "run")
    assert buckets().null_keys == {"subscriptions", "invoicing", "costs", "sales_tags"}
    monkeypatch.setattr(pipeline, "BUCKET_ROWS", 20)
    assert buckets() is not None
    hot = spark.read.parquet(layers.table("bronze", "invoicing")).withColumn("subscription_id", F.lit("S1")).localCheckpoint()
    hot.write.mode("overwrite").parquet(layers.table("bronze", "invoicing"))
    assert buckets() is None


def test_profitability_of_buckets_needs_no_shuffle(spark, tmp_path):
    spark.sql(f"CREATE DATABASE IF NOT EXISTS bucket_plan LOCATION '{tmp_path}/db'")
    stored = Buckets("bucket_plan", "run", 3, "subscription_id")
    rows = spark.range(200).selectExpr("concat('S', id % 20) subscription_id", "date_add(date'2022-01-01', cast(id as int)) start",
                                       "id * 0.5D calculated_cost")
    for name, df in (("invoicing", rows), ("costs", rows.selectExpr("subscription_id", "start month", "calculated_cost Cost").where("Cost > 20"))):
        save_bucketed(df, stored.table(name), "subscription_id", 3, f"{tmp_path}/{name}")
    inv, costs = (spark.table(stored.table(n)) for n in ("invoicing", "costs"))
    text = lambda df: spark._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "simple")
    with setting(spark, "spark.sql.autoBroadcastJoinThreshold", "-1"), setting(spark, pipeline.CO_PARTITION, "false"):
        fact = marts.fct_profitability(inv, costs, partitions=3)
        assert "Exchange" not in text(fact) and "SortMergeJoin" in text(fact), text(fact)
        assert "Exchange hash" not in text(quality.dataset_checks("invoicing", inv, ["subscription_id"], by=["subscription_id"]))
        assert "Exchange" not in text(marts.dim_subscription(inv).repartition(3, "subscription_id"))
        got = sorted(map(repr, fact.collect()))
    plain = marts.fct_profitability(*(spark.read.parquet(f"{tmp_path}/{n}") for n in ("invoicing", "costs")))
    assert got == sorted(map(repr, plain.collect())) and len(got) > 20


def test_one_hash_shows_no_copies_two_count_them(spark, monkeypatch):
    df = spark.createDataFrame([("S1", 1), ("S2", 2), ("S2", 2), (None, 3)], "subscription_id string, v int")
    exact = {"t": df, "u": df.distinct()}
    keys = {n: ["subscription_id"] for n in exact}
    want = sorted(map(repr, map(tuple, quality.dq_report(exact, {}, keys).collect())))
    assert sorted(map(repr, quality.dq_rows(exact, {}, keys))) == want
    # a hash that all rows share makes no copies of different rows
    two = dedup.row_hashes
    monkeypatch.setattr(dedup, "row_hashes", lambda cols, hashes=2: two(cols) if hashes == 2 else [F.lit(0).cast("long").alias("__h1")])
    assert sorted(map(repr, quality.dq_rows(exact, {}, keys))) == want


def test_raw_copy_and_shuffles_are_freed(spark, tmp_path):
    layers = Layers(str(tmp_path))
    _raw(layers.root)
    run_pipeline(spark, layers, database="gold_freed", post_gate=False)
    assert path_exists(spark, layers.raw)  # a user's own files stay
    before = spark.conf.get(FREE_SHUFFLES, None)
    run_pipeline(spark, layers, database="gold_freed", post_gate=False, keep_raw=False)
    assert not path_exists(spark, layers.raw) and spark.conf.get(FREE_SHUFFLES, None) == before


def test_exports_hold_the_roles_in_row_order(spark, tmp_path):
    d = str(tmp_path)
    lines = spark.range(400).selectExpr(
        "CASE WHEN id % 31 = 0 THEN NULL ELSE id % 45 END l_orderkey", "id % 9 l_partkey", "id % 4 l_suppkey", "cast(id % 8 as int) l_linenumber",
        "cast(id % 3 as double) l_extendedprice", "if(id % 2 = 0, 'R', 'N') l_returnflag", "timestamp_ntz'2022-01-05 00:00:00' + make_interval(0, id % 3) l_shipdate")
    lines.write.parquet(f"{d}/lineitem.parquet")
    spark.range(8).selectExpr("id p_partkey", "concat('t', id % 3) p_type", "concat('b', id) p_brand", "cast(id % 7 as int) p_size").write.parquet(f"{d}/part.parquet")
    by_sub = lambda rows: {s: [r[1:] for r in rows if r[0] == s] for s in {r[0] for r in rows}}
    cols = ["subscription_id", "month", "Cost"]
    costs = roles.costs_raw(spark, d).orderBy("subscription_id", "_row_order")
    assert by_sub(roles.costs_export(spark, d).collect()) == by_sub(costs.select(cols).collect())
    tags = roles.sales_tags(spark, d).orderBy("subscription_id", "_row_order").select("subscription_id", "tag")
    assert by_sub(roles.sales_tags_export(spark, d).collect()) == by_sub(tags.collect())
