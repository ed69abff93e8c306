"""Pipeline control flow: pre-checks, the post-transform gate, missing inputs."""

import pytest

from billow.plans.pipeline import run_pipeline
from billow.plans.quality import DataQualityError
from billow.sources.csv import path_exists
from billow.sources.layers import Layers
from tests.conftest import write_csv_file


def _raw(root, customers=(("C1", "Ada"),), with_costs=True):
    raw = f"{root}/raw"
    write_csv_file(f"{raw}/Customers.csv", ["customer_id", "name"], list(customers))
    write_csv_file(f"{raw}/Subscriptions.csv", ["subscription_id", "Customer", "status", "cancelled_at"],
                   [("S1", "C1", "SUBSCRIPTION_STATUS_PAUSED", None), ("S1", "C1", "SUBSCRIPTION_STATUS_PAUSED", None)])
    write_csv_file(f"{raw}/Invoicing.csv", ["subscription_id", "calculated_cost", "start"],
                   [("S1", "10.5", "2022-09-01"), (None, "3", "2022-09-01")])
    if with_costs:
        write_csv_file(f"{raw}/Costs.csv", ["subscription_id", "month", "Cost"], [("S1", "01/09/2022", "4.5")])
    return raw


def test_pre_checks_fail_on_raw_problems(spark, tmp_path):
    root = str(tmp_path)
    _raw(root)
    # raw subscriptions hold a whole-row duplicate and invoicing a null key
    with pytest.raises(DataQualityError) as err:
        run_pipeline(spark, Layers(root), database="gold_pre", pre_checks=True)
    assert "duplicate_rows" in str(err.value) and "null_count" in str(err.value)


def test_post_gate_stops_before_gold(spark, tmp_path):
    root = str(tmp_path)
    _raw(root, customers=())  # header only: silver customers is empty
    with pytest.raises(DataQualityError) as err:
        run_pipeline(spark, Layers(root), database="gold_stop")
    assert "customers: not_empty" in str(err.value)
    assert not path_exists(spark, f"{root}/gold/fct_profitability")


def test_missing_costs_fails_gate_but_model_gives_zero_cost(spark, tmp_path):
    root = str(tmp_path)
    _raw(root, with_costs=False)
    # as in the reference, a missing silver table fails the post-transform check
    with pytest.raises(DataQualityError, match="costs: present"):
        run_pipeline(spark, Layers(root), database="gold_nocost")
    # without the gate the model keeps every sale with cost 0.0
    result = run_pipeline(spark, Layers(root), database="gold_nocost", post_gate=False)
    assert "costs" in result.skipped
    assert result.warnings == ["costs: not in raw, skipped", "sales_tags: not in raw, skipped"]
    rows = spark.sql("SELECT * FROM gold_nocost.fct_profitability").collect()
    assert [(r.subscription_id, r.month, r.sales_amount, r.cost_amount) for r in rows] == [
        ("S1", "2022-09", 10.5, 0.0)]
    failed = {(r.dataset, r.check) for r in result.dq.collect() if r.passed is False}
    assert failed == {("costs", "present")}


def test_restart_from_written_layers(spark, tmp_path):
    root = str(tmp_path)
    _raw(root)
    first = run_pipeline(spark, Layers(root), database="gold_restart", post_gate=False)
    before = sorted(map(tuple, spark.sql("SELECT * FROM gold_restart.fct_profitability").collect()))
    for stage in ("transform", "model"):
        again = run_pipeline(spark, Layers(root), database="gold_restart", post_gate=False, start_at=stage)
        assert again.ingested == {}
        assert (again.steps == []) == (stage == "model")
        assert sorted(map(tuple, spark.sql("SELECT * FROM gold_restart.fct_profitability").collect())) == before
        bronze_rows = {r.dataset: r.value for r in again.dq.collect() if r.check == "bronze_rows"}
        assert bronze_rows == {n: c for n, c in first.ingested.items() if n in bronze_rows}
    with pytest.raises(ValueError):
        run_pipeline(spark, Layers(root), start_at="silver")


def test_empty_dimension_is_still_written(spark, tmp_path):
    root = str(tmp_path)
    _raw(root, customers=())            # header only
    result = run_pipeline(spark, Layers(root), database="gold_empty_dim", post_gate=False)
    assert spark.sql("SELECT COUNT(*) AS n FROM gold_empty_dim.dim_customer").first().n == 0
    assert "dim_customer" in result.gold
