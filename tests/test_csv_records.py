"""Quoted line breaks across splits, stray quotes, and records with more fields than the header."""

import csv
import io
import random

import pytest
from pyspark.sql import functions as F

from billow.sources import csv as c
from billow.sources import records

TINY = {"spark.sql.files.maxPartitionBytes": "40", "spark.sql.files.openCostInBytes": "1", "spark.sql.files.minPartitionNum": "1"}


@pytest.fixture
def tiny_splits(spark):
    """Splits of 40 bytes, so that records begin in one split and end in another."""
    before = {k: spark.conf.get(k, None) for k in TINY}
    for k, v in TINY.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


def write(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    with open(path, "w", newline="") as f:
        f.write(text)
    return str(path)


def got(df):
    names = [n for n in df.columns if n not in (c.ORDINAL, c.MALFORMED)]
    return [tuple(r[n] for n in names) for r in df.orderBy(c.ORDINAL).collect()]


def wanted(text):
    rows = [r for r in csv.reader(io.StringIO(text, newline="")) if r and any(x.strip() for x in r)]
    return [tuple(x if x not in c.NULL_TOKENS else None for x in r) for r in rows[1:]]


def field(rng):
    return rng.choice(["", "x", "long " * rng.randint(1, 30), "two\nlines", "a\n\nb\n", 'say "x"', '"', "\n", ",", '",', ',"\n",', "ü\nß", "line\r\nbreak", '5" pipe', " 12 "])


@pytest.mark.parametrize("seed", range(4))
def test_random_records_over_many_splits(spark, tmp_path, tiny_splits, seed):
    rng, out = random.Random(seed), io.StringIO(newline="")
    w = csv.writer(out, lineterminator="\r\n" if seed % 2 else "\n")
    w.writerow(["key", "note", "more"])
    for i in range(60):
        w.writerow([f"k{i}", field(rng), field(rng)])
    text = out.getvalue()
    path = write(tmp_path / "a.csv", text)
    df = c.read_csv(spark, path)
    assert got(df) == wanted(text)
    assert df.select(c.ORDINAL).distinct().count() == 60
    assert records._lines(spark, [path]).rdd.getNumPartitions() > 20  # no file is read by one task


def test_a_record_over_several_splits(spark, tmp_path, tiny_splits):
    text = "key,note\nA,1\nB,\"" + "\n".join(f"line {i} of a long, long note" for i in range(30)) + "\"\nC,3\nD,\"4\n4\"\n"
    assert got(c.read_csv(spark, write(tmp_path / "a.csv", text))) == wanted(text)


def test_plain_quotes_are_text(spark, tmp_path, tiny_splits):
    """A quote within an unquoted field opens nothing; such files are read as they are."""
    text = 'key,note\nA,5" pipe\nB,6" pipe\nC,"quoted, one"\n'
    path = write(tmp_path / "a.csv", text)
    assert records.files_with_breaks(spark, [path]) == []
    assert got(c.read_csv(spark, path)) == [("A", '5" pipe'), ("B", '6" pipe'), ("C", "quoted, one")]
    mixed = text + 'D,"two\nlines"\nE,7" pipe\nF,x\n'
    path = write(tmp_path / "b.csv", mixed)
    assert got(c.read_csv(spark, path)) == [("A", '5" pipe'), ("B", '6" pipe'), ("C", "quoted, one"), ("D", "two\nlines"), ("E", '7" pipe'), ("F", "x")]


def test_only_files_with_breaks_are_put_together(spark, tmp_path, tiny_splits):
    folder = tmp_path / "my data.csv"
    write(folder / "part-2.csv", 'key,note\nA,"x\ny"\nB,b\n')
    write(folder / "part-10.csv", "key,note\nC,c\n")
    assert len(records.files_with_breaks(spark, [str(folder)])) == 1
    assert got(c.read_csv(spark, str(folder))) == [("A", "x\ny"), ("B", "b"), ("C", "c")]
    assert got(c.read_csv(spark, str(folder), multiline=True)) == [("A", "x\ny"), ("B", "b"), ("C", "c")]


def test_header_with_break_blank_lines_and_other_header(spark, tmp_path, tiny_splits):
    text = '\n"first\nname",b\n\n1,"2\n"\n\n3,4\n'
    df = c.read_csv(spark, write(tmp_path / "h.csv", text))
    assert df.columns[:2] == ["first\nname", "b"] and got(df) == [("1", "2\n"), ("3", "4")]
    folder = tmp_path / "f.csv"
    write(folder / "1.csv", 'a,b\n1,"x\ny"\n')
    write(folder / "2.csv", 'b,a\n1,"x\ny"\n')
    with pytest.raises(ValueError, match="header"):
        c.read_csv(spark, str(folder))


def test_unclosed_quote_is_an_error(spark, tmp_path, tiny_splits):
    with pytest.raises(records.UnclosedQuote):
        c.read_csv(spark, write(tmp_path / "a.csv", 'a,b\n1,"x\ny\nz\n'))


@pytest.mark.parametrize("broken", [False, True])
def test_extra_fields_are_never_lost(spark, tmp_path, broken):
    text = 'a,b,c\n1,x,y\n2,x,y,EXTRA\n3,"q,r",y\n4,"q ""r"", s",y,\n5,short\n' + ('6,"two\nlines",y,EXTRA\n' if broken else "")
    path = write(tmp_path / "a.csv", text)
    with pytest.raises(Exception, match="more fields than the header"):
        c.read_csv(spark, path).select("a").collect()
    kept = c.read_csv(spark, path, malformed="keep")
    assert {r.a for r in kept.where(F.col(c.MALFORMED).isNotNull()).collect()} == {"2", "4"} | ({"6"} if broken else set())
    assert kept.where("a = '2'").first()[c.MALFORMED] == "2,x,y,EXTRA"
    assert [tuple(r) for r in kept.where("a = '5'").select("a", "b", "c").collect()] == [("5", "short", None)]


def test_ends_inside_follows_the_quotes(spark):
    """Every line against a machine that reads one character after another."""
    def machine(line, inside):
        state = "in" if inside else "start"
        for ch in line:
            if state == "in":
                state = "quote" if ch == '"' else "in"
            elif state == "quote" and ch == '"':
                state = "in"
            elif ch == ",":
                state = "start"
            else:
                state = "in" if state == "start" and ch == '"' else "text"
        return int(state == "in")

    rng = random.Random(1)
    lines = list({"".join(rng.choices('",a', k=rng.randint(0, 9))) for _ in range(2000)})
    df = spark.createDataFrame([(x,) for x in lines], "line string").select("line", records.ends_inside("line", False).alias("o"), records.ends_inside("line", True).alias("i"))
    assert all((r.o, r.i) == (machine(r.line, False), machine(r.line, True)) for r in df.collect())


def test_empty_part_files_beside_files_with_breaks(spark, tmp_path):
    write(tmp_path / "a.csv" / "part-0.csv", "")
    write(tmp_path / "a.csv" / "part-1.csv", 'key,note\n1,"two\nlines"\n')
    write(tmp_path / "a.csv" / "part-2.csv", "\n")
    assert got(c.read_csv(spark, str(tmp_path / "a.csv"))) == [("1", "two\nlines")]
    write(tmp_path / "a.csv" / "part-3.csv", "key,note\n2,plain\n")
    assert got(c.read_csv(spark, str(tmp_path / "a.csv"))) == [("1", "two\nlines"), ("2", "plain")]


def test_compressed_files_are_cut_and_keep_their_order(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(c, "COMPRESSED_ROWS", 10)
    rows = [(i, f"note {i}" if i % 7 else "two\nlines") for i in range(95)]
    c.write_csv(spark.createDataFrame(rows, "key long, note string").coalesce(1), str(tmp_path / "a.csv"), compression="gzip")
    assert len([*(tmp_path / "a.csv").glob("*.csv.gz")]) == 10
    assert got(c.read_csv(spark, str(tmp_path / "a.csv"))) == [(str(k), n) for k, n in rows]
