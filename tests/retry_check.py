"""Run in its own process (needs task retries: master local[4,3]).

A task of the scan stage fails once; the retried job must give the same
result, row ordinals included.  Prints "RETRY_OK <rows>" on success.
"""

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402
from pyspark.sql.types import BooleanType  # noqa: E402


def main(sf_dir: str, flag_dir: str) -> None:
    spark = (SparkSession.builder.master("local[4,3]").config("spark.ui.enabled", "false")
             .config("spark.sql.shuffle.partitions", "4").config("spark.sql.session.timeZone", "UTC")
             .getOrCreate())
    spark.sparkContext.setLogLevel("OFF")
    flag = os.path.join(flag_dir, "failed_once")

    def fail_once(_):
        if not os.path.exists(flag):
            open(flag, "w").close()
            raise RuntimeError("injected task failure")
        return True

    import __spark_entry__ as e
    from billow.operators import dedup
    from billow.sources import csv as csvsrc
    from billow.sources import roles

    # 1) gold fact with a failure in the cost scan
    expected = sorted(map(repr, e.q_fct_profitability(spark, sf_dir).collect()))
    plain_costs = roles.costs
    roles.costs = lambda s, d: plain_costs(s, d).where(F.udf(fail_once, BooleanType())("subscription_id"))
    got = sorted(map(repr, e.q_fct_profitability(spark, sf_dir).collect()))
    roles.costs = plain_costs
    assert os.path.exists(flag) and got == expected, "fact differs after retry"

    # 2) CSV row ordinals with a failure in the CSV scan
    path = os.path.join(flag_dir, "costs_csv")
    csvsrc.write_csv(roles.costs_raw(spark, sf_dir).orderBy("subscription_id", "_row_order"), path)
    first = sorted(map(repr, dedup.keep_last(csvsrc.read_csv(spark, path), ["subscription_id", "month"]).collect()))
    os.remove(flag)
    failing = csvsrc.read_csv(spark, path).where(F.udf(fail_once, BooleanType())("subscription_id"))
    second = sorted(map(repr, dedup.keep_last(failing, ["subscription_id", "month"]).collect()))
    assert os.path.exists(flag) and first == second, "keep-last differs after retry"
    # 3) dropped-row counts with a failure in a map task of the subscriptions plan
    from billow.plans import pipeline
    from billow.sources import layers
    from billow.spec import billing_specs
    root = os.path.join(flag_dir, "run")
    subs = spark.createDataFrame([(f"S{i % 40}" if i % 9 else None, "C1", "SUBSCRIPTION_STATUS_PAUSED") for i in range(200)],
                                 "subscription_id string, Customer string, status string").repartition(4)
    tags = spark.createDataFrame([(f"S{i % 40}", f"type{i % 3}:x") for i in range(120)], "subscription_id string, tag string")
    csvsrc.write_csv(subs, f"{root}/raw/Subscriptions.csv")
    csvsrc.write_csv(tags, f"{root}/raw/Sales tags.csv")
    run = layers.Layers(root)
    pipeline.ingest(spark, run.raw, run.bronze)
    specs = {"subscriptions": billing_specs()["subscriptions"]}
    good = pipeline.transform(spark, run, specs, datasets={"subscriptions", "sales_tags"})
    plain_read = pipeline.read_layer

    def failing_read(s, path):
        df = plain_read(s, path)
        return df.where(F.udf(fail_once, BooleanType())(df.columns[0])) if "/bronze/" in path else df
    for name in ("subscriptions", "sales_tags"):
        os.remove(flag)
        pipeline.read_layer = lambda s, path, n=name: failing_read(s, path) if path.endswith(n) else plain_read(s, path)
        again = pipeline.transform(spark, run, specs, datasets={"subscriptions", "sales_tags"})
        assert os.path.exists(flag) and again.steps == good.steps and again.silver == good.silver, (again.steps, good.steps)
    print("RETRY_OK", len(got), len(first), flush=True)


if __name__ == "__main__":
    main(sys.argv[1], sys.argv[2])
