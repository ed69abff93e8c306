"""Every registered query equals its DuckDB oracle on the smallest test tables."""

import os

import pytest

from tools.oracle_check import compare

SF = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")
def test_all_queries_match_oracle(spark):
    import __spark_entry__ as e
    results = compare(spark, SF, list(e.ORACLE), verbose=False)
    bad = {k: v for k, v in results.items() if v[0] != "OK"}
    assert not bad, bad


def test_entry_runs(spark):
    import __spark_entry__ as e
    df = e.entry(spark)
    assert df.columns == ["subscription_id", "month", "sales_amount", "cost_amount", "profit"]
    assert df.count() > 0


def test_reconciliations_balance(spark):
    import __spark_entry__ as e
    for name in ("reconcile_sales", "reconcile_costs"):
        df = e.queries()[name](spark, SF)
        assert df.where("difference <> 0").count() == 0, name
        assert df.count() > 0


def test_every_query_has_an_oracle():
    import __spark_entry__ as e
    assert set(e.QUERIES) == set(e.ORACLE)


def test_bench_prints_one_json_line(tmp_path):
    import json
    import subprocess
    import sys
    repo = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = dict(os.environ, BENCH_SF_DIR=SF, BENCH_CPUS="2", BENCH_REPEAT="1")
    out = subprocess.run([sys.executable, os.path.join(repo, "bench.py")], capture_output=True, text=True,
                         timeout=900, env=env, cwd=str(tmp_path))
    lines = [line for line in out.stdout.splitlines() if line.strip()]
    assert len(lines) == 1, out.stdout[-2000:] + out.stderr[-2000:]
    result = json.loads(lines[0])
    assert {"metric", "value", "unit", "queries", "sf"} <= set(result) and result["unit"] == "sec"
    assert result["sf"] == 0.001 and len(result["queries"]) >= 10
