import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from billow.llm import line_dedup as d

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for k, y in enumerate(b, 1):
            last, row[k] = row[k], min(row[k] + 1, row[k - 1] + 1, last + (x != y))
    return row[-1]


def brute(rows, edits=2, min_words=5, near_chars=20):
    """rows of (doc_id, text) -> (doc_id, lines, removed numbers, near ones)."""
    lines = []
    for doc, text in rows:
        for n, raw in enumerate((text or "").split("\n") if text is not None else []):
            line = raw.strip(d.ENDS)
            if len(WORD.findall(line)) >= min_words:
                lines.append((d.LAST if doc is None else doc, n, line))
    first = {}
    for doc, n, line in sorted(lines):
        first.setdefault(line, (doc, n))
    texts = [t for t in first if len(t) >= near_chars]
    late = {b for b in texts for a in texts if abs(len(a) - len(b)) <= edits and first[a] < first[b] and distance(a, b) <= edits}
    gone, near = {}, {}
    for doc, n, line in lines:
        if line in late or first[line] != (doc, n):
            gone.setdefault(doc, set()).add(n)
            near.setdefault(doc, set()).update([n] if line in late else [])
    return Counter((doc, 0 if text is None else len(text.split("\n")), tuple(sorted(gone.get(key, ()))), len(near.get(key, ())))
                   for doc, text in rows for key in [d.LAST if doc is None else doc])


def run(df, **options):
    return Counter((r.doc_id, r.n_lines, tuple(r.removed), r.n_near) for r in d.dedup_report(df, **options).collect())


def changed(rng, line, edits):
    chars = list(line)
    for _ in range(edits if chars else 0):
        if not chars:
            break
        i, kind = rng.randrange(len(chars)), rng.randrange(3)
        if kind == 0:
            chars[i] = rng.choice("xyzé ")
        elif kind == 1:
            chars.insert(i, rng.choice("xyz😀"))
        else:
            del chars[i]
    return "".join(chars)


@pytest.mark.parametrize("edits", [1, 2, 3])
def test_edits_equal_brute_force(spark, edits):
    rng = random.Random(edits)
    base = [" ".join(rng.choice(["alpha", "be", "gamma", "de", "epsilon", "ñu"]) for _ in range(rng.randrange(5, 12))) for _ in range(25)]
    rows = []
    for i in range(60):
        lines = [changed(rng, rng.choice(base), rng.randrange(0, edits + 2)) for _ in range(rng.randrange(1, 5))] + ["short one", f"own line number {i} of this text", ""]
        rng.shuffle(lines)
        rows.append((i, "\n".join(lines)))
    got = run(spark.createDataFrame(rows, "doc_id long, text string"), edits=edits)
    assert got == brute(rows, edits) and sum(n for *_, n in got) > 5


def test_banded_words_equal_the_distance(spark):
    rng = random.Random(9)
    pairs = []
    for _ in range(400):
        a = "".join(rng.choice("abc") for _ in range(rng.randrange(1, 9)))
        pairs.append((a, changed(rng, a + "q", rng.randrange(0, 4))))
    df = spark.createDataFrame([p for p in pairs if abs(len(p[0]) - len(p[1])) <= 2 and p[1]], "a string, b string")
    df = df.select("a", "b", F.split("a", "").alias("ca"), F.split("b", "").alias("cb"))
    assert all(r.ok == (distance(r.a, r.b) <= 2) for r in df.withColumn("ok", d.within_edits(2)).collect())


def test_documents(docs):
    sample = docs.where("doc_id < 60")
    assert run(sample) == brute([(r.doc_id, r.text) for r in sample.collect()])


def test_odd_rows(odd, none):
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    got = run(odd)
    assert got == brute(rows)
    assert d.dedup_report(none).count() == 0 and d.dedup_lines(none).columns == none.columns


def test_rewritten_texts_keep_all_columns(spark, odd):
    rows = [(1, "first line has five words\nsmall", "x"), (2, "first line has five words", "y"), (3, "  first line has five words \nnew words are in this line", "z"), (4, None, None), (5, "", "")]
    df = spark.createDataFrame(rows, "doc_id long, text string, removed string")
    out = d.dedup_lines(df)
    assert out.columns == df.columns
    assert {(r.doc_id, r.text, r.removed) for r in out.collect()} == {rows[0], (3, "new words are in this line", "z"), (4, None, None), (5, "", "")}
    assert {r.doc_id for r in d.dedup_lines(df, keep_share=0.8).collect()} == {1, 4, 5}


def test_main_path_is_native(docs):
    plan = d.keyed(d.lines_of(docs), 2, 20)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_rows_without_id_and_repeated_ids_are_known_by_their_text(spark):
    """A line goes from the rows that repeat it, not from others of the same id, and equal places of two rows are told apart."""
    shared, low = "a line that two rows share at one place", -(1 << 63)
    rows = [(None, "one line that stands here alone\nseen before in the first document"), (None, "other lines that stand here alone\nfresh words that no document has"),
            (None, f"{shared}\nx1"), (None, f"{shared}\nx2"), (7, f"{shared} too\nx1"), (7, f"{shared} too\nx2"), (7, f"{shared} too\nx2"),
            (1, "seen before in the first document"), (low, "smallest number of all the documents"), (d.LAST, "smallest number of all the documents"),
            (None, "smallest number of all the documents"), (None, "largest number after all the others"), (d.LAST, "largest number after all the others")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = Counter((r.doc_id, r.text) for r in d.dedup_lines(df).collect())
    report = Counter((r.doc_id, tuple(r.removed)) for r in d.dedup_report(df).collect())
    assert got[None, rows[0][1].split("\n")[0]] == 1 and got[None, rows[1][1]] == 1
    assert {got[None, f"{shared}\nx{i}"] + got[None, f"x{i}"] for i in (1, 2)} == {1} and got[None, "x1"] + got[None, "x2"] == 1
    # the two equal rows of id 7 share their decision, whichever text comes first
    assert (got[7, f"{shared} too\nx1"], got[7, "x2"]) == (1, 2) or (got[7, "x1"], got[7, f"{shared} too\nx2"]) == (1, 2)
    assert got[low, rows[8][1]] == 1 and got[d.LAST, rows[8][1]] == got[None, rows[8][1]] == 0
    assert got[d.LAST, rows[12][1]] == 1 and got[None, rows[12][1]] == 0
    assert sum(report.values()) == len(rows) and report[None, (1,)] == 1


def test_near_lines_of_repeated_rows_count_once(spark):
    rows = [(1, "a line of text that stands in the first row"), (2, "a line of text that stands in the first rows"), (2, "a line of text that stands in the first rows")]
    assert run(spark.createDataFrame(rows, "doc_id long, text string")) == Counter({(1, 1, (), 0): 1, (2, 1, (0,), 1): 2})
