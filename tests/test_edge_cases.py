"""Small fixtures for the semantic decisions (FIXTURES.md section 3)."""

import datetime as dt

from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from billow.functions import dayfirst_date, lenient_date, null_tokens_to_null, sale_type
from billow.functions.text import churn_flag, normalise_dataset_name
from billow.operators import dedup
from billow.plans import marts
from billow.plans.clean import clean_dataset, dropped_rows_report
from billow.plans.quality import DataQualityError, dq_report, gate, orphan_costs
from billow.sources.csv import list_csv_datasets, read_csv, read_optional
from billow.spec import ORDINAL, billing_specs
from tests.conftest import write_csv_file


def _one_col(spark, values, name="v"):
    return spark.createDataFrame([(v,) for v in values], StructType([StructField(name, StringType())]))


def test_bad_dates_become_null(spark):
    rows = _one_col(spark, ["bad", "31/02/2022", None]).select(dayfirst_date("v").alias("d")).collect()
    assert [r.d for r in rows] == [None, None, None]


def test_iso_and_dayfirst_months(spark):
    df = _one_col(spark, ["2022-09-01", "15/10/2022"])
    got = df.select(dayfirst_date("v").alias("a"), dayfirst_date("v", "ydm").alias("b")).collect()
    assert got[0].a == dt.date(2022, 9, 1) and got[0].b == dt.date(2022, 1, 9)
    assert got[1].a == dt.date(2022, 10, 15)


def test_mixed_timestamps_and_offset(spark):
    df = _one_col(spark, ["2022-10-05 19:42:38.6228", "2022-10-05 19:42:38", "2022-10-05",
                          "2022-10-05T23:30:00-05:00"])
    got = [r.d for r in df.select(lenient_date("v").alias("d")).collect()]
    assert got == [dt.date(2022, 10, 5)] * 3 + [dt.date(2022, 10, 6)]


def test_null_tokens(spark):
    df = _one_col(spark, ["", "NA", "N/A", "null", "x"])
    assert [r.v for r in df.select(null_tokens_to_null("v").alias("v")).collect()] == [None] * 4 + ["x"]


def test_tags(spark):
    df = _one_col(spark, ["directSale:a", ":x", "plain", " a :b", None])
    got = [r.s for r in df.select(sale_type("v").alias("s")).collect()]
    assert got == ["DIRECTSALE", "", "PLAIN", " A ", None]


def test_churn_flag(spark):
    df = spark.createDataFrame([(None, None), (None, "2022-01-01"), ("Cancelled", None), ("ACTIVE", None)],
                               "status string, cancelled_at string")
    got = [r.is_churned for r in df.select(churn_flag("status", "cancelled_at")).collect()]
    assert got == [False, True, True, False]


def test_all_null_sum_is_zero_and_null_month_joins(spark):
    inv = spark.createDataFrame([("S", None, None), ("S", None, "2022-01-03")],
                                "subscription_id string, calculated_cost double, start string")
    costs = spark.createDataFrame([("S", None, 5.0)], "subscription_id string, month string, Cost double")
    rows = {r.month: r for r in marts.fct_profitability(inv, costs).collect()}
    assert rows["2022-01"].sales_amount == 0.0
    assert rows[None].cost_amount == 5.0 and rows[None].profit == -5.0


def test_no_costs_table(spark, tmp_path):
    inv = spark.createDataFrame([("S", 3.0, "2022-01-03")], "subscription_id string, calculated_cost double, start string")
    schema = StructType([StructField("subscription_id", StringType()), StructField("month", StringType()),
                         StructField("Cost", DoubleType())])
    costs = read_optional(spark, str(tmp_path / "missing.csv"), schema)
    assert costs.count() == 0
    r = marts.fct_profitability(inv, costs).first()
    assert (r.cost_amount, r.profit) == (0.0, 3.0)
    r2 = marts.fct_profitability(inv, None).first()
    assert r2.cost_amount == 0.0


def test_cost_without_invoice_is_orphan(spark):
    inv = spark.createDataFrame([("S", 3.0, "2022-01-03")], "subscription_id string, calculated_cost double, start string")
    costs = spark.createDataFrame([("S", "2022-01-01", 1.0), ("S", "2022-02-01", 2.0)],
                                  "subscription_id string, month string, Cost double")
    assert [r.month for r in marts.fct_profitability(inv, costs).collect()] == ["2022-01"]
    assert [(r.month, r.cost_amount) for r in orphan_costs(costs, inv).collect()] == [("2022-02", 2.0)]


def test_duplicate_rows_with_nulls(spark):
    df = spark.createDataFrame([("a", None, 1.0)] * 3, "subscription_id string, x string, y double")
    assert dedup.drop_row_duplicates(df).count() == 1
    assert dedup.row_duplicate_count(df).first().duplicate_rows == 2
    rep = {r.step: r.rows_dropped for r in dropped_rows_report(df, billing_specs()["invoicing"]).collect()}
    assert rep == {"not_null:subscription_id": 0, "dedupe": 2}


def test_two_tags_one_subscription(spark):
    from billow.plans.enrich import enrich_subscriptions
    subs = spark.createDataFrame([("S", "C", "x", None, 1)],
                                 "subscription_id string, Customer string, status string, cancelled_at string, "
                                 f"{ORDINAL} int")
    tags = spark.createDataFrame([("S", "partner:a", 2), ("S", "direct:b", 1)],
                                 f"subscription_id string, tag string, {ORDINAL} int")
    silver = enrich_subscriptions(subs, tags)
    assert silver.count() == 2
    assert marts.dim_subscription(silver).first().sale_type == "DIRECT"
    assert marts.fct_churn(silver).count() == 2


def test_keep_last_across_files_and_splits(spark, tmp_path):
    folder = tmp_path / "raw" / "costs.csv"
    n = 30000
    for f in range(3):
        rows = [("S", "2022-01-01", float(f * n + i)) for i in range(n)]
        write_csv_file(str(folder / f"part-{f}.csv"), ["subscription_id", "month", "Cost"], rows)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "65536")
    try:
        df = read_csv(spark, str(folder), StructType([StructField("Cost", DoubleType())]))
        assert df.rdd.getNumPartitions() > 3
        out = clean_dataset(df, billing_specs()["costs"]).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert [r.Cost for r in out] == [float(3 * n - 1)]
    first = dedup.keep_first(df, ["subscription_id"]).first()
    assert first.Cost == 0.0


def test_file_names_normalised(spark, tmp_path):
    write_csv_file(str(tmp_path / "Customers.csv"), ["customer_id"], [("C",)])
    write_csv_file(str(tmp_path / "Sales tags.csv"), ["subscription_id", "tag"], [("S", "a:b")])
    write_csv_file(str(tmp_path / "sub" / "nested.csv"), ["x"], [("1",)])
    assert sorted(list_csv_datasets(spark, str(tmp_path))) == ["customers", "sales_tags"]
    assert normalise_dataset_name("Sales tags.csv") == "sales_tags"


def test_gate_raises_on_failure(spark):
    bad = spark.createDataFrame([(None, "C"), ("S", "C"), ("S", "C")], "customer_id string, x string")
    report = dq_report({"customers": bad}, {}, {"customers": ("customer_id",)})
    checks = {r.check: r.passed for r in report.collect()}
    assert checks["null_count"] is False and checks["duplicate_rows"] is False
    try:
        gate(report)
    except DataQualityError as exc:
        assert "customers" in str(exc)
    else:
        raise AssertionError("gate did not raise")


def test_missing_dataset_is_reported(spark):
    ok = spark.createDataFrame([("C",)], "customer_id string")
    report = dq_report({"customers": ok, "costs": None}, {},
                       {"customers": ("customer_id",), "costs": ("subscription_id",)})
    missing = [r for r in report.collect() if r.dataset == "costs"]
    assert [(r.check, r.passed) for r in missing] == [("present", False)]


def test_money_sum_is_order_independent(spark):
    vals = [0.1] * 10 + [1e6, -1e6]
    df = spark.createDataFrame([("k", v) for v in vals], "k string, v double").repartition(7)
    from billow.functions import money_sum
    assert df.groupBy("k").agg(money_sum("v").alias("s")).first().s == 1.0


def test_keep_last_skipped_without_its_whole_key(spark):
    df = spark.createDataFrame([("S", 1.0), ("S", 2.0)], "subscription_id string, Cost double")
    out = clean_dataset(df, billing_specs()["costs"])
    assert sorted(r.Cost for r in out.collect()) == [1.0, 2.0]


def test_status_domain_is_known(spark):
    from billow.plans.analytics import value_domain
    from billow.sources import roles
    known = {f"SUBSCRIPTION_STATUS_{x}" for x in ("ACTIVATED", "PENDING", "CANCELLED", "PAUSED")}
    got = {r.status for r in value_domain(roles.subscriptions_raw(spark, "/root/testdata/sf0.001"), "status").collect()}
    assert got and got <= known


def test_windows_export_bom_and_crlf(spark, tmp_path):
    path = tmp_path / "costs.csv"
    path.write_bytes(b"\xef\xbb\xbfsubscription_id,Cost\r\nS1,1.5\r\nS2,NA\r\n")
    df = read_csv(spark, str(path), StructType([StructField("Cost", DoubleType())]), with_ordinal=False)
    assert df.columns == ["subscription_id", "Cost"]
    assert [(r.subscription_id, r.Cost) for r in df.collect()] == [("S1", 1.5), ("S2", None)]


def test_dates_do_not_depend_on_session_time_zone(spark):
    values = ["2022-10-05 23:42:38.6228", "2022-10-05", "2022-10-05T23:30:00-05:00",
              "2022-10-05T01:30:00Z", "2022-10-05T01:30:00+0530", "15/10/2022", "bad"]
    df = _one_col(spark, values)
    expect = [dt.date(2022, 10, 5), dt.date(2022, 10, 5), dt.date(2022, 10, 6), dt.date(2022, 10, 5),
              dt.date(2022, 10, 4), None, None]
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        for zone in ("UTC", "America/New_York", "Asia/Kolkata"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            assert [r.d for r in df.select(lenient_date("v").alias("d")).collect()] == expect, zone
            assert df.select(dayfirst_date("v").alias("d")).collect()[5].d == dt.date(2022, 10, 15)
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_quoted_line_breaks(spark, tmp_path):
    path = tmp_path / "Customers.csv"
    path.write_text('customer_id,note\nC1,"two\nlines"\nC2,plain\n')
    rows = read_csv(spark, str(path), with_ordinal=False).collect()
    assert sorted((r.customer_id, r.note) for r in rows) == [("C1", "two\nlines"), ("C2", "plain")]


def test_file_metadata_without_jvm_access(spark, tmp_path, monkeypatch):
    """The Spark-only fallbacks (for clients without JVM access) give the same answers."""
    from billow.sources import csv as csvsrc
    write_csv_file(str(tmp_path / "Customers.csv"), ["customer_id"], [("C",)])
    write_csv_file(str(tmp_path / "Sales tags.csv" / "part-0.csv"), ["subscription_id", "tag"], [("S", "a:b")])
    write_csv_file(str(tmp_path / "sub" / "nested.csv"), ["x"], [("1",)])
    folder, missing = str(tmp_path), str(tmp_path / "nope")
    with_jvm = (csvsrc.list_csv_datasets(spark, folder), csvsrc.path_exists(spark, folder),
                csvsrc.path_exists(spark, missing), csvsrc.folder_bytes(spark, folder))
    monkeypatch.setattr(csvsrc, "_hadoop_fs", lambda *_: None)
    without = (csvsrc.list_csv_datasets(spark, folder), csvsrc.path_exists(spark, folder),
               csvsrc.path_exists(spark, missing), csvsrc.folder_bytes(spark, folder))
    norm = lambda d: {k: v.replace("file:", "") for k, v in d.items()}
    assert norm(without[0]) == norm(with_jvm[0]) and sorted(with_jvm[0]) == ["customers", "sales_tags"]
    assert without[1:] == with_jvm[1:] and with_jvm[1:3] == (True, False)
    assert read_csv(spark, without[0]["sales_tags"], with_ordinal=False).count() == 1


def test_two_date_columns_compile_to_short_methods(spark):
    """Beyond 8,000 bytes the JVM never compiles a method: the parsers of several date columns must not meet in one."""
    from billow.plans.clean import parse_dates
    from billow.spec import billing_specs
    df = spark.range(1).selectExpr("cast(id as string) created_at", "cast(id as string) start", "cast(id as string) end")
    parsed = parse_dates(df, billing_specs()["invoicing"], losses=True)
    stages = parsed._jdf.queryExecution().debug().codegenToSeq()
    assert all(stages.apply(i)._3().maxMethodCodeSize() < 8000 for i in range(stages.size()))
