"""Property tests: operators against a brute-force Python model on random tables.

Random keys (with nulls), ordinals, duplicate rows and partition counts; the
Spark result must equal the plain-Python answer.
"""

from decimal import Decimal

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from billow.operators import dedup
from billow.plans import marts

KEYS = st.sampled_from(["a", "b", "c", None])
ROWS = st.lists(st.tuples(KEYS, st.integers(0, 3), st.integers(-5, 5)), min_size=0, max_size=40)
SETTINGS = settings(max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def _frame(spark, rows, parts):
    data = [(k, g, v, i) for i, (k, g, v) in enumerate(rows)]
    return spark.createDataFrame(data, "k string, g int, v int, ord int").repartition(parts)


@SETTINGS
@given(rows=ROWS, parts=st.integers(1, 5), latest=st.booleans())
def test_keep_latest_matches_model(spark, rows, parts, latest):
    df = _frame(spark, rows, parts)
    got = {(r.k, r.g): (r.v, r.ord) for r in dedup.keep_latest(df, ["k", "g"], ["ord"], latest).collect()}
    want = {}
    for i, (k, g, v) in enumerate(rows):
        if (k, g) not in want or latest:
            want[(k, g)] = (v, i)
    assert got == want


@SETTINGS
@given(rows=ROWS, parts=st.integers(1, 5))
def test_duplicates_match_model(spark, rows, parts):
    df = _frame(spark, rows, parts).drop("ord")
    distinct = set(rows)
    assert dedup.drop_row_duplicates(df, exclude=()).count() == len(distinct)
    assert dedup.row_duplicate_count(df, exclude=()).first().duplicate_rows == len(rows) - len(distinct)
    groups = {(r.k, r.g, r.v): r.duplicate_count for r in dedup.duplicate_groups(df, exclude=()).collect()}
    assert groups == {t: rows.count(t) for t in distinct if rows.count(t) > 1}


MONEY = st.one_of(st.none(), st.decimals(min_value=-1000, max_value=1000, places=2, allow_nan=False))
DATES = st.one_of(st.none(), st.sampled_from(["2022-01-03", "2022-01-31", "2022-02-01", "bad", "15/02/2022"]))


@SETTINGS
@given(rows=st.lists(st.tuples(st.sampled_from(["s1", "s2"]), MONEY, DATES), max_size=30),
       parts=st.integers(1, 4))
def test_monthly_sum_matches_model(spark, rows, parts):
    data = [(s, float(m) if m is not None else None, d) for s, m, d in rows]
    df = spark.createDataFrame(data, "subscription_id string, amount double, month string").repartition(parts)
    out = marts.monthly_sum(df, "subscription_id", "month", "amount", "total", dayfirst=True)
    got = {(r.subscription_id, r.month): r.total for r in out.select("subscription_id", marts.month_text(), "total").collect()}
    month = {"2022-01-03": "2022-01", "2022-01-31": "2022-01", "2022-02-01": "2022-02", "15/02/2022": "2022-02"}
    want = {}
    for s, m, d in rows:
        key = (s, month.get(d))
        want.setdefault(key, Decimal(0))
        if m is not None:
            want[key] += m
    assert got == {k: float(v) for k, v in want.items()}


_PART = st.sampled_from(["2022", "22", "1", "01", "9", "12", "13", "31", "32", "0"])
DATE_TEXT = st.one_of(
    st.builds(lambda y, m, d: f"{y}-{m}-{d}", _PART, _PART, _PART),
    st.builds(lambda d, m, y: f"{d}/{m}/{y}", _PART, _PART, _PART),
    st.builds(lambda y, m, d, t: f"{y}-{m}-{d}{t}", _PART, _PART, _PART,
              st.sampled_from(["T10:30:00", " 23:59:59.5", "T23:30:00-05:00", "T01:00:00Z"])),
    st.text(alphabet="0123456789-/:TZ +.", max_size=12),
)


@SETTINGS
@given(values=st.lists(DATE_TEXT, min_size=1, max_size=30), order=st.sampled_from(["ymd", "ydm"]))
def test_dayfirst_dispatch_equals_trying_formats_in_turn(spark, values, order):
    from pyspark.sql import functions as F

    from billow.functions.dates import (DAYFIRST_FORMAT, ISO_DATE_FORMAT, YDM_DATE_FORMAT,
                                        dayfirst_date, lenient_date)
    df = spark.createDataFrame([(v,) for v in values], "v string")
    iso = YDM_DATE_FORMAT if order == "ydm" else ISO_DATE_FORMAT
    chain = F.coalesce(F.try_to_date("v", iso), F.try_to_date("v", DAYFIRST_FORMAT), lenient_date("v"))
    diff = df.where(~dayfirst_date("v", order).eqNullSafe(chain)).collect()
    assert diff == []


COST_ROWS = st.lists(st.tuples(st.sampled_from(["s1", "s2", None]),
                               st.sampled_from(["2022-01-01", "01/02/2022", "bad", None]),
                               st.sampled_from([1.5, 2.25, None])), max_size=30)


def _model_clean_costs(rows):
    """Reference order: parse month, keep last per (sub, month), drop null sub, dedupe."""
    month = {"2022-01-01": "2022-01-01", "01/02/2022": "2022-02-01"}
    parsed = [(s, month.get(m), c) for s, m, c in rows]
    last = {}
    for s, m, c in parsed:                  # file order: later rows win
        last[(s, m)] = (s, m, c)
    kept = list(last.values())
    not_null = [r for r in kept if r[0] is not None]
    return set(not_null), [("keep_last", len(rows), len(kept)),
                           ("not_null:subscription_id", len(kept), len(not_null)),
                           ("dedupe", len(not_null), len(set(not_null)))]


@SETTINGS
@given(rows=COST_ROWS, parts=st.integers(1, 4))
def test_clean_costs_and_step_counts_match_model(spark, rows, parts):
    from billow.plans.clean import clean_dataset, dropped_rows_report
    from billow.spec import billing_specs
    spec = billing_specs()["costs"].with_order("ord")
    df = spark.createDataFrame([(s, m, c, i) for i, (s, m, c) in enumerate(rows)],
                               "subscription_id string, month string, Cost double, ord int").repartition(parts)
    want_rows, want_steps = _model_clean_costs(rows)
    got_rows = {(r.subscription_id, str(r.month) if r.month else None, r.Cost)
                for r in clean_dataset(df, spec).collect()}
    assert got_rows == want_rows
    got_steps = [(r.step, r.rows_before, r.rows_after) for r in dropped_rows_report(df, spec).collect()]
    assert got_steps == want_steps


@SETTINGS
@given(sales=st.lists(st.tuples(st.sampled_from(["s1", "s2"]), st.sampled_from(["2022-01-05", "2022-02-10", None]),
                                st.sampled_from([10.0, 2.5, None])), max_size=20),
       costs=st.lists(st.tuples(st.sampled_from(["s1", "s2", "s3"]), st.sampled_from(["2022-01-01", "01/02/2022", None]),
                                st.sampled_from([1.25, 4.0])), max_size=20))
def test_profitability_matches_model(spark, sales, costs):
    inv = spark.createDataFrame(sales, "subscription_id string, start string, calculated_cost double")
    cst = spark.createDataFrame(costs, "subscription_id string, month string, Cost double")
    got = {(r.subscription_id, r.month): (r.sales_amount, r.cost_amount, r.profit)
           for r in marts.fct_profitability(inv, cst).collect()}
    inv_month = {"2022-01-05": "2022-01", "2022-02-10": "2022-02"}
    cost_month = {"2022-01-01": "2022-01", "01/02/2022": "2022-02"}
    s_tot, c_tot = {}, {}
    for s, d, a in sales:
        s_tot[(s, inv_month.get(d))] = s_tot.get((s, inv_month.get(d)), Decimal(0)) + Decimal(str(a or 0))
    for s, d, a in costs:
        c_tot[(s, cost_month.get(d))] = c_tot.get((s, cost_month.get(d)), Decimal(0)) + Decimal(str(a))
    want = {k: (float(v), float(c_tot.get(k, 0)), float(v) - float(c_tot.get(k, 0))) for k, v in s_tot.items()}
    assert got == want
