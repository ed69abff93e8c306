"""End-to-end run on the reference's recorded billing rows (two subscriptions)."""

import pytest
from pyspark.sql import functions as F

from billow.plans.pipeline import run_pipeline, steps_frame
from billow.sources.layers import Layers
from billow.spec import billing_specs
from tests.conftest import write_csv_file

S1_COSTS = [("S1", "2022-09-01", 53.97184), ("S1", "2022-10-01", 34.17152), ("S1", "2022-10-01", 74.2512),
            ("S1", "2022-11-01", 54.77024), ("S1", "2022-12-01", 90.85792)]
S2_COSTS = [("S2", "2022-09-01", 39.28128), ("S2", "2022-10-01", 31.936), ("S2", "2022-10-01", 52.37504),
            ("S2", "2022-11-01", 69.62048), ("S2", "2022-12-01", 36.40704)]
S1_INVOICES = [
    ("S1", 29.0, "2022-09-01", "2022-09-30", "2022-10-05 19:42:38.6228"),
    ("S1", 29.0, "2022-09-01", "2022-09-30", "2022-11-01 19:37:01.677686"),
    ("S1", 29.0, "2022-10-01", "2022-10-31", "2022-11-01 19:37:01.677686"),
    ("S1", 29.0, "2022-11-01", "2022-11-30", "2022-12-18 20:54:09.209639"),
    ("S1", 29.0, "2022-11-01", "2022-11-30", "2022-11-29 16:44:52.49871"),
    ("S1", 29.0, "2022-12-01", "2022-12-31", "2022-12-18 20:54:09.209639"),
    ("S1", 29.0, "2023-01-01", "2023-01-31", "2023-01-11 15:45:55.113256"),
]
S2_INVOICES = [
    ("S2", 29.0, "2022-09-01", "2022-09-30", "2022-10-05 19:32:06.735091"),
    ("S2", 29.0, "2022-10-01", "2022-10-31", "2022-11-01 19:37:30.931282"),
    ("S2", 29.0, "2022-11-01", "2022-11-30", "2022-11-29 16:43:58.525387"),
    ("S2", 29.0, "2022-12-01", "2022-12-31", "2022-12-18 20:53:11.350095"),
    ("S2", 29.0, "2023-01-01", "2023-01-31", "2023-01-11 15:43:34.144538"),
]
EXPECTED = {
    ("S1", "2022-09"): (58.0, 53.97184, 4.02816),
    ("S1", "2022-10"): (29.0, 74.2512, -45.2512),
    ("S1", "2022-11"): (58.0, 54.77024, 3.229759999999999),
    ("S1", "2022-12"): (29.0, 90.85792, -61.85791999999999),
    ("S1", "2023-01"): (29.0, 0.0, 29.0),
    ("S2", "2022-09"): (29.0, 39.28128, -10.281280000000002),
    ("S2", "2022-10"): (29.0, 52.37504, -23.37504),
    ("S2", "2022-11"): (29.0, 69.62048, -40.62048),
    ("S2", "2022-12"): (29.0, 36.40704, -7.407040000000002),
    ("S2", "2023-01"): (29.0, 0.0, 29.0),
}


@pytest.fixture(scope="module")
def golden_run(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("golden"))
    raw = f"{root}/raw"
    write_csv_file(f"{raw}/Customers.csv", ["customer_id", "name"], [("C1", "Ada"), ("C2", "Bo")])
    write_csv_file(f"{raw}/Subscriptions.csv", ["subscription_id", "Customer", "status", "cancelled_at"],
                   [("S1", "C1", "SUBSCRIPTION_STATUS_ACTIVATED", None),
                    ("S2", "C2", "SUBSCRIPTION_STATUS_CANCELLED", "2023-02-01 10:00:00")])
    write_csv_file(f"{raw}/Invoicing.csv", ["subscription_id", "calculated_cost", "start", "end", "created_at"],
                   S1_INVOICES + S2_INVOICES)
    write_csv_file(f"{raw}/Costs.csv", ["subscription_id", "month", "Cost"], S1_COSTS + S2_COSTS)
    write_csv_file(f"{raw}/Sales tags.csv", ["subscription_id", "tag"],
                   [("S1", "directSale:web"), ("S2", "partnerSale:x"), ("S2", "onlineSale:y")])
    from pyspark.sql.types import DoubleType, StructField, StructType
    schemas = {"invoicing": StructType([StructField("calculated_cost", DoubleType())]),
               "costs": StructType([StructField("Cost", DoubleType())])}
    layers = Layers(root)
    db = "gold_golden"
    result = run_pipeline(spark, layers, schemas, database=db)
    return spark, layers, result, db


def test_profitability_golden_rows(golden_run):
    spark, _, result, db = golden_run
    rows = spark.sql(f"SELECT * FROM {db}.fct_profitability").collect()
    got = {(r.subscription_id, r.month): (r.sales_amount, r.cost_amount, r.profit) for r in rows}
    assert set(got) == set(EXPECTED)
    # bit-exact: the recorded doubles, e.g. 3.229759999999999 and -61.85791999999999
    assert got == EXPECTED


def test_keep_last_cost_in_silver(golden_run):
    spark, layers, _, _ = golden_run
    silver = spark.read.parquet(layers.table("silver", "costs"))
    oct_s1 = silver.where("subscription_id = 'S1' AND month = DATE'2022-10-01'").collect()
    assert [r.Cost for r in oct_s1] == [74.2512]
    assert silver.count() == 8


def test_steps_report_counts(golden_run):
    spark, _, result, _ = golden_run
    steps = {(r.dataset, r.step): r.rows_dropped for r in steps_frame(spark, result).collect()}
    assert steps[("costs", "keep_last")] == 2
    assert steps[("costs", "not_null:subscription_id")] == 0


def test_dq_report_passes(golden_run):
    _, _, result, _ = golden_run
    rows = result.dq.collect()
    assert all(r.passed is not False for r in rows)
    # bronze counts in the report are the ones observed at ingest
    assert {r.dataset: r.value for r in rows if r.check == "bronze_rows"} == {
        n: c for n, c in result.ingested.items() if n != "sales_tags"}
    assert result.ingested == {"customers": 2, "subscriptions": 2, "invoicing": 12, "costs": 10, "sales_tags": 3}


def test_dim_and_churn(golden_run):
    spark, _, _, db = golden_run
    dim = {r.subscription_id: r.sale_type for r in spark.sql(f"SELECT * FROM {db}.dim_subscription").collect()}
    assert dim == {"S1": "DIRECTSALE", "S2": "PARTNERSALE"}
    churn = spark.sql(f"SELECT subscription_id, is_churned FROM {db}.fct_churn").collect()
    assert sorted((r.subscription_id, r.is_churned) for r in churn) == [
        ("S1", False), ("S2", True), ("S2", True)]
    summary = {r.is_churned: r.subs for r in spark.sql(
        f"SELECT is_churned, COUNT(*) AS subs FROM {db}.fct_churn GROUP BY is_churned").collect()}
    assert summary == {False: 1, True: 2}


def test_ydm_option_reproduces_reference_silver_months(spark):
    from billow.plans.clean import clean_dataset
    spec = billing_specs()["costs"]
    from dataclasses import replace
    spec = replace(spec, date_order="ydm")
    df = spark.createDataFrame([(s, m, c, i) for i, (s, m, c) in enumerate(S1_COSTS)],
                               "subscription_id string, month string, Cost double, ord long")
    out = clean_dataset(df, spec.with_order("ord")).orderBy("month").collect()
    assert [str(r.month) for r in out] == ["2022-01-09", "2022-01-10", "2022-01-11", "2022-01-12"]
    assert [r.Cost for r in out] == [53.97184, 74.2512, 54.77024, 90.85792]


def test_gold_sum_equals_invoices(golden_run):
    spark, layers, _, db = golden_run
    gold = spark.sql(f"SELECT SUM(sales_amount) AS s FROM {db}.fct_profitability").first().s
    inv = spark.read.parquet(layers.table("silver", "invoicing")).agg(F.sum("calculated_cost")).first()[0]
    assert abs(gold - inv) < 1e-9


def test_command_line_run(tmp_path):
    import os
    import subprocess
    import sys
    raw = tmp_path / "raw"
    write_csv_file(str(raw / "Customers.csv"), ["customer_id", "name"], [("C1", "Ada")])
    write_csv_file(str(raw / "Subscriptions.csv"), ["subscription_id", "Customer", "status", "cancelled_at"],
                   [("S1", "C1", "SUBSCRIPTION_STATUS_CANCELLED", None)])
    write_csv_file(str(raw / "Invoicing.csv"), ["subscription_id", "calculated_cost", "start", "end", "created_at"],
                   S1_INVOICES)
    write_csv_file(str(raw / "Costs.csv"), ["subscription_id", "month", "Cost"], S1_COSTS)
    repo = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = dict(os.environ, PYTHONPATH=repo, PYSPARK_SUBMIT_ARGS="--master local[2] pyspark-shell")
    out = subprocess.run([sys.executable, "-m", "billow", "run", "--root", str(tmp_path), "--query"],
                         capture_output=True, text=True, timeout=600, cwd=str(tmp_path), env=env)
    assert out.returncode == 0, out.stderr[-3000:]
    assert "fct_profitability" in out.stdout and "2022-10" in out.stdout
    assert "Churn summary" in out.stdout
    # a separate process reads gold from the folder, like a later query session
    later = subprocess.run([sys.executable, "-m", "billow", "query", "--root", str(tmp_path)],
                           capture_output=True, text=True, timeout=600, cwd=str(tmp_path), env=env)
    assert later.returncode == 0, later.stderr[-3000:]
    assert "2022-10" in later.stdout and "true" in later.stdout
