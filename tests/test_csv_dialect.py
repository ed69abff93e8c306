import datetime as dt
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from billow.functions import dayfirst_date, lenient_date
from billow.functions.money import money_sum
from billow.operators.dedup import drop_row_duplicates
from billow.sources import csv as c

SCHEMA = StructType([StructField("key", StringType()), StructField("note", StringType()), StructField("amount", DoubleType())])


def write(path, *texts):
    os.makedirs(path, exist_ok=True)
    for i, t in enumerate(texts):
        with open(f"{path}/part-{i}.csv", "w", newline="") as f:
            f.write(t)
    return str(path)


def rows(df):
    return sorted((r.key, r.note, r.amount) for r in df.collect())


def test_doubled_quotes_commas_and_line_breaks(spark, tmp_path):
    path = write(tmp_path / "a.csv", 'key,note,amount\nS1,"say ""x"", y",10\nS2,"two\nlines",5\n')
    assert rows(c.read_csv(spark, path, SCHEMA)) == [("S1", 'say "x", y', 10.0), ("S2", "two\nlines", 5.0)]


def test_values_come_back_as_written(spark, tmp_path):
    values = [("a", " padded ", 1.0), ("b", 'quote " and, comma', 2.0), ("c", "line\nbreak", 3.0)]
    c.write_csv(spark.createDataFrame(values, SCHEMA), str(tmp_path / "out"))
    assert rows(c.read_csv(spark, str(tmp_path / "out"), SCHEMA)) == values


def test_other_header_order_is_an_error(spark, tmp_path):
    path = write(tmp_path / "b.csv", "key,note,amount\nS1,x,10\n", "amount,note,key\n7,y,S2\n")
    with pytest.raises(Exception, match="(?i)header|schema"):
        c.read_csv(spark, path, SCHEMA).collect()


def test_part_files_in_number_order(spark, tmp_path):
    names = ["/x/part-99999-c.csv", "/x/part-100000-c.csv", "/x/costs_9.csv", "/x/costs_10.csv"]
    assert sorted(names, key=c.natural_key) == [names[2], names[3], names[0], names[1]]
    folder = tmp_path / "many parts.csv"
    folder.mkdir()
    for n in (10, 9, 100, 2):
        (folder / f"part {n}%20+é.csv").write_text("key,note,amount\n" + "".join(f"S{n},r{i},1\n" for i in range(3)))
    for multiline in (None, False, True):
        rows = c.read_csv(spark, str(folder), SCHEMA, multiline=multiline).orderBy(c.ORDINAL).collect()
        assert [(r.key, r.note) for r in rows] == [(f"S{n}", f"r{i}") for n in (2, 9, 10, 100) for i in range(3)]
        assert len({r[c.ORDINAL] for r in rows}) == 12


def test_ordinal_is_one_number_and_groups_by_hash(spark, tmp_path):
    path = write(tmp_path / "a.csv", "key,note,amount\nS1,x,10\nS1,x,10\nS2,y,5\n")
    df = c.read_csv(spark, path, SCHEMA)
    assert df.schema[c.ORDINAL].dataType == c.ORDINAL_TYPE
    once = drop_row_duplicates(df)
    assert "SortAggregate" not in once._jdf.queryExecution().toString()
    assert [r.key for r in once.orderBy(c.ORDINAL).collect()] == ["S1", "S2"]


def test_file_without_rank_is_an_error(spark, tmp_path):
    path = write(tmp_path / "a.csv", "key,note,amount\nS1,x,10\n")
    with pytest.raises(Exception, match="not in the listing"):
        c._scan(spark, [path], {"file:/other": 0, "file:/another": 1}).select(c.ORDINAL).collect()


def test_small_units_and_large_totals(spark):
    df = spark.createDataFrame([(4e-7,)] * 1000, "x double")
    assert df.agg(money_sum("x").alias("s")).first().s == pytest.approx(0.0004)
    assert spark.createDataFrame([(6e12,)] * 3, "x double").agg(money_sum("x").alias("s")).first().s == 1.8e13


def test_date_shapes(spark):
    day = dt.date(2022, 10, 5)
    texts = ["05-10-2022", "5.10.2022", "5 Oct 2022", "5-Oct-22", "20221005", "2022/10/05", "5/10/2022", "2022-10-05"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert {r.d for r in df.select(dayfirst_date("t").alias("d")).collect()} == {day}
    zones = spark.createDataFrame([("2022-10-05 23:30:00 America/New_York",), ("2022-10-06",), ("10/06/2022",)], "t string")
    assert {r.d for r in zones.select(lenient_date("t").alias("d")).collect()} == {dt.date(2022, 10, 6)}


def test_each_shape_has_one_parser_and_the_same_answer(spark):
    """The casts of the usual shapes against the patterns they stand for."""
    import itertools

    from billow.functions.dates import DAYFIRST_FORMAT, ISO_DATE_FORMAT
    days, months, years = ("00", "01", "9 ", " 9", "29", "30", "31", "32", "+1", "a1"), ("00", "02", "09", "12", "13", "1 "), ("2022", "2024", "0000", "20a2", " 022")
    texts = [f"{d}/{m}/{y}" for d, m, y in itertools.product(days, months, years)] + [f"{y}-{m}-{d}" for d, m, y in itertools.product(days, months, years)]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    plain = F.when(F.instr("t", "/") > 0, F.try_to_date("t", DAYFIRST_FORMAT)).otherwise(F.try_to_date("t", ISO_DATE_FORMAT))
    odd = df.select("t", dayfirst_date("t").cast("string").alias("got"), plain.cast("string").alias("want")).where("NOT (got <=> want)")
    assert [r.t for r in odd.collect() if " " not in r.t] == []  # ISO text with spaces goes on to the timestamp reading
    assert odd.where("t LIKE '%/%'").isEmpty()


def test_buckets_follow_the_rows():
    from billow.plans.pipeline import BUCKET_ROWS, bucket_counts
    assert bucket_counts({}) == {"customer_id": 1, "subscription_id": 1}
    assert bucket_counts({"customers": 5, "subscriptions": 10, "invoicing": 10 * BUCKET_ROWS + 1}) == {"customer_id": 1, "subscription_id": 11}
