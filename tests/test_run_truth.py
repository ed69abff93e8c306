"""Nothing is lost without a count, and no stage takes another run's tables."""

import datetime as dt

import pytest

from billow.plans.pipeline import run_pipeline, transform
from billow.plans.quality import DataQualityError, reconcile_costs
from billow.sources.csv import path_exists
from billow.sources.layers import Layers, ingest, quarantine
from billow.sources.manifest import ManifestError, read_manifest
from billow.spec import billing_schemas, billing_specs
from tests.conftest import write_csv_file


def raw(root, invoices='S1,10.5,2022-09-01\n', costs="S1,01/09/2022,4.5\n"):
    folder = f"{root}/raw"
    write_csv_file(f"{folder}/Customers.csv", ["customer_id", "name"], [("C1", "two\nlines"), ("C2", 'a "b"')])
    write_csv_file(f"{folder}/Subscriptions.csv", ["subscription_id", "Customer", "status", "cancelled_at"], [("S1", "C1", "SUBSCRIPTION_STATUS_PAUSED", None)])
    for name, head, body in (("Invoicing", "subscription_id,calculated_cost,start\n", invoices), ("Costs", "subscription_id,month,Cost\n", costs)):
        if body is not None:
            with open(f"{folder}/{name}.csv", "w", newline="") as f:
                f.write(head + body)
    return Layers(root)


def failed(result):
    return {(r.dataset, r.check, r.column_name, r.value) for r in result.dq.collect() if r.passed is False}


def test_default_run_reads_quoted_line_breaks(spark, tmp_path):
    layers = raw(str(tmp_path), 'S1,10.5,2022-09-01\n"S\n2",1,2022-09-02\n')
    run_pipeline(spark, layers, database="truth_breaks")
    assert {r.name for r in spark.read.parquet(layers.table("bronze", "customers")).collect()} == {"two\nlines", 'a "b"'}
    assert {(r.subscription_id, r.sales_amount) for r in spark.table("truth_breaks.fct_profitability").collect()} == {("S1", 10.5), ("S\n2", 1.0)}


def test_extra_fields_go_to_quarantine_and_fail_the_gate(spark, tmp_path):
    layers = raw(str(tmp_path), "S1,10.5,2022-09-01\nS2,5,2022-01-01,EXTRA\n")
    with pytest.raises(DataQualityError, match="invoicing: malformed_rows = 1"):
        run_pipeline(spark, layers, database="truth_extra")
    result = run_pipeline(spark, layers, database="truth_extra", post_gate=False)
    assert result.malformed["invoicing"] == 1 and result.ingested["invoicing"] == 1
    assert [r.record for r in spark.read.parquet(quarantine(layers.bronze, "invoicing")).collect()] == ["S2,5,2022-01-01,EXTRA"]
    assert ("invoicing", "malformed_rows", None, 1) in failed(result)
    raw(str(tmp_path))  # mended export: the earlier records leave the quarantine
    assert run_pipeline(spark, layers, database="truth_extra").malformed["invoicing"] == 0
    assert spark.read.parquet(quarantine(layers.bronze, "invoicing")).isEmpty()


def test_lost_values_are_counted(spark, tmp_path):
    layers = raw(str(tmp_path), 'S1,10.5,2022-09-01\nS1,"1,234.50",2022-09-02\nS1,NA,\nS1,3,no date\nS1,3,no date\n', "S1,31/31/2022,4.5\nS1,31/31/2022,5\nS1,,1\n")
    with pytest.raises(DataQualityError, match="invoicing: lost_values:bronze calculated_cost = 1"):
        run_pipeline(spark, layers, database="truth_lost")
    result = run_pipeline(spark, layers, database="truth_lost", post_gate=False)
    lost = {(n, layer, c): k for n, layer, c, k in result.losses if k}
    assert lost == {("invoicing", "bronze", "calculated_cost"): 1, ("invoicing", "silver", "start"): 2, ("costs", "silver", "month"): 2}
    assert failed(result) == {("invoicing", "lost_values:bronze", "calculated_cost", 1)}  # dates are counted, not judged
    assert any(r.check == "lost_values:silver" and r.value == 2 and r.passed is None for r in result.dq.collect())


def test_a_run_without_costs_takes_no_old_costs(spark, tmp_path):
    layers = raw(str(tmp_path))
    run_pipeline(spark, layers, database="truth_stale")
    assert spark.table("truth_stale.fct_profitability").first().cost_amount == 4.5
    (tmp_path / "raw" / "Costs.csv").unlink()
    assert path_exists(spark, layers.table("bronze", "costs")) and path_exists(spark, layers.table("silver", "costs"))
    with pytest.raises(DataQualityError, match="costs: present"):
        run_pipeline(spark, layers, database="truth_stale")
    result = run_pipeline(spark, layers, database="truth_stale", post_gate=False)
    assert "costs" in result.skipped and spark.table("truth_stale.fct_profitability").first().cost_amount == 0.0
    for stage in ("transform", "model"):  # a restart takes what that run wrote
        run_pipeline(spark, layers, database="truth_stale", post_gate=False, start_at=stage)
        assert spark.table("truth_stale.fct_profitability").first().cost_amount == 0.0


def test_restart_checks_the_tables(spark, tmp_path):
    layers = raw(str(tmp_path))
    with pytest.raises(ManifestError, match="no finished bronze"):
        run_pipeline(spark, layers, database="truth_restart", start_at="transform")
    first = run_pipeline(spark, layers, database="truth_restart")
    run_id, tables = read_manifest(spark, layers.root, "bronze")
    assert run_id == first.run_id and {n: e.rows for n, e in tables.items()} == first.ingested
    spark.createDataFrame([("S9", "x", 1.0)], "subscription_id string, month string, Cost double").write.mode("overwrite").parquet(layers.table("bronze", "costs"))
    with pytest.raises(ManifestError, match="costs is not what run"):
        run_pipeline(spark, layers, database="truth_restart", start_at="transform")
    with pytest.raises(ManifestError):
        transform(spark, layers, billing_specs())


def test_gold_as_csv(spark, tmp_path):
    layers = raw(str(tmp_path), costs="")
    run_pipeline(spark, layers, database="truth_csv", export_csv=True, post_gate=False)
    rows = spark.read.option("header", True).csv(f"{layers.gold}_csv/fct_profitability").collect()
    assert [(r.subscription_id, r.month, r.sales_amount) for r in rows] == [("S1", "2022-09", "10.5")]


def test_ingest_alone_reports(spark, tmp_path):
    layers = raw(str(tmp_path), "S1,x,2022-09-01\nS1,1,2022-09-01,,\n")
    done = ingest(spark, layers.raw, layers.bronze, billing_schemas())
    assert (done["invoicing"].rows, done["invoicing"].malformed, done["invoicing"].losses) == (1, 1, {"calculated_cost": 1})
    assert done["customers"].rows == 2 and done["customers"].losses == {}


def test_small_costs_are_reconciled(spark):
    """A cost of 4e-7 is money: it stands in the silver total and in gold."""
    day = dt.date(2022, 9, 1)
    costs = spark.createDataFrame([("S1", day, 4e-7), ("S2", day, 1.0), (None, day, 2.0)], "subscription_id string, month date, Cost double")
    sales = spark.createDataFrame([("S1", day, 1.0)], "subscription_id string, start date, calculated_cost double")
    gold = spark.createDataFrame([("S1", 4e-7)], "subscription_id string, cost_amount double")
    rows = {r.subscription_id: (r.silver_cost, r.gold_cost, r.orphan_cost, r.difference) for r in reconcile_costs(costs, gold, sales).collect()}
    assert rows == {"S1": (4e-7, 4e-7, 0.0, 0.0), "S2": (1.0, 0.0, 1.0, 0.0), None: (2.0, 0.0, 2.0, 0.0)}
