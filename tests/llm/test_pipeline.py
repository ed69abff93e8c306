import json
import random
import re

import pytest

import corpus_pipeline as c
from tests.llm.test_line_dedup import brute as brute_lines
from tests.llm.test_ngram_join import brute as brute_join
from tests.llm.test_ngram_join import shingles
from tests.llm.test_quality_rules import brute_base


@pytest.fixture(scope="module")
def sf(spark, tmp_path_factory):
    """A small corpus: prose, junk, copies, near copies, shared lines; an extra column and a null row."""
    rng = random.Random(4)
    vocabulary = ["".join(rng.choice(["re", "an", "tion", "ou", "st", "e"]) for _ in range(rng.randrange(1, 4))) for _ in range(300)]
    prose = lambda n: "\n".join(" ".join(rng.choice(vocabulary) for _ in range(rng.randrange(8, 20))) for _ in range(n))
    texts = [prose(rng.randrange(3, 9)) for _ in range(120)]
    texts += ["### $$$ %%% " * 30, "short", "", None, texts[3], texts[3], "a shared line of many words here\n" + texts[5]]
    near = texts[7].replace("\n", " ").split()
    texts += [" ".join(near), " ".join(["new", *near[1:]])]
    texts += [t + "\na shared line of many words here" for t in texts[10:14]]
    rows = [(i, t, "en", f"s{i % 3}", 1, "kept as it is") for i, t in enumerate(texts)]
    d = str(tmp_path_factory.mktemp("sf"))
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, __extra string").write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame([(i, int(i < 120 or i > 126), i % 2) for i in range(len(rows))], "doc_id long, quality int, toxic int").write.parquet(f"{d}/labels.parquet")
    return d


def test_each_stage_against_its_plain_version(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = {r.doc_id: r.text for r in docs.collect()}
    names, stages = [n for n, _ in c.STAGES], [f for _, f in c.STAGES]
    assert len(names) == 5

    one = c.stored(stages[0](spark, docs, sf), "t")
    kept = {r.doc_id: r.text for r in one.collect()}
    assert one.columns == docs.columns and kept == {i: t for i, t in rows.items() if not brute_base(t)[5]}

    two = c.stored(stages[1](spark, one, sf), "t")
    got = {r.doc_id: r.text for r in two.collect()}
    want = {}
    for doc, _, gone, _ in brute_lines(list(kept.items())):
        text = "\n".join(x for n, x in enumerate(kept[doc].split("\n")) if n not in gone)
        if not gone or text and len(text) >= c.KEEP_SHARE * len(kept[doc]):
            want[doc] = text
    assert two.columns == docs.columns and got == want and 124 not in got and len(got) >= 120

    three = c.stored(stages[2](spark, two, sf), "t")
    assert {r.doc_id: r.text for r in three.collect()} == {d: got[d] for d, _, least in brute_join(list(got.items())) if d == least}

    four = c.stored(stages[3](spark, three, sf), "t")
    assert four.columns == docs.columns
    before, after = {r.doc_id: r for r in three.collect()}, {r.doc_id: r for r in four.collect()}
    assert after.items() <= before.items() and len(after) > 0

    five = stages[4](spark, four, sf).collect()
    assert {r.doc_id for r in five} == set(after) and all(r.lossless and r.n_pieces == len(r.ids) for r in five)


def test_run_and_empty_input(spark, sf, tmp_path):
    out = c.run(spark, sf)
    assert out.count() > 0 and c.run(spark, sf).exceptAll(out).isEmpty()
    for t in ("documents", "labels"):
        spark.read.parquet(f"{sf}/{t}.parquet").limit(0).write.parquet(f"{tmp_path}/{t}.parquet")
    assert c.run(spark, str(tmp_path)).count() == 0


def test_odd_rows(spark, odd, sf):
    docs = odd
    for _, stage in c.STAGES[:-1]:
        docs = c.stored(stage(spark, docs, sf), "t")
        assert docs.columns == odd.columns
    assert c.STAGES[-1][1](spark, docs, sf).count() == docs.count()


def test_registered():
    import __spark_entry__ as e

    assert "pipeline" in e.queries() and {f"op{n}" for n in range(1, 14)} == {q.split("_")[0] for q in e.queries() if re.match(r"op\d+_", q)}
    assert json.dumps(sorted(e.oracle_sql())) and c.run


def test_near_duplicates_share_four_fifths_of_five_word_runs(spark, tmp_path):
    """Texts of 50 words with one or two words changed: 0.80 of the 5-word runs but 0.84 of the 4-word runs for one."""
    rng, rows = random.Random(8), []
    for i in range(0, 60, 3):
        words = [f"w{i}x{k}" for k in range(rng.randrange(44, 58))]
        one, two = list(words), list(words)
        one[20] = two[12] = two[30] = "changed"
        rows += [(i, " ".join(words)), (i + 1, " ".join(one)), (i + 2, " ".join(two))]
    sets = {d: shingles(t, 5) for d, t in rows}
    close = lambda a, b: 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])
    # families share no words, so a document goes where a chain of links within its three reaches a smaller id
    want = set()
    for i in range(0, 60, 3):
        ab, ac, bc = close(i, i + 1), close(i, i + 2), close(i + 1, i + 2)
        want |= {i} | ({i + 1} if not (ab or ac and bc) else set()) | ({i + 2} if not (ac or bc) else set())
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id for r in c.near_duplicates(spark, docs, str(tmp_path)).collect()}
    assert got == want and 60 > len(got) > 20
    assert want != {d for d, _, least in brute_join(rows) if d == least}
