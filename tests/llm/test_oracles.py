import __spark_entry__ as e
from billow.llm.oracles import ORACLE
from tools.oracle_check import compare


def test_queries_equal_their_sql(spark):
    assert set(ORACLE) <= set(e.oracle_sql())
    results = compare(spark, "/root/testdata/sf0.001", list(ORACLE), verbose=False)
    assert all(v[0] == "OK" for v in results.values()), results
