import itertools
import zlib

import numpy as np
import pytest

from billow.llm import line_crf as c


def test_marginals_equal_enumeration():
    rng = np.random.default_rng(1)
    emit, trans, starts = rng.normal(size=9), rng.normal(size=(2, 2)), np.array([0, 4, 5, 9])
    p, pairs, log_z = c.marginals(emit, trans, starts)
    want, want_pairs, want_z = np.zeros(9), np.zeros((2, 2)), 0.0
    for a, b in itertools.pairwise(starts):
        total, good, trs = 0.0, np.zeros(b - a), np.zeros((2, 2))
        for y in itertools.product((0, 1), repeat=b - a):
            w = np.exp(sum(e for e, k in zip(emit[a:b], y) if k) + sum(trans[i, j] for i, j in itertools.pairwise(y)))
            total += w
            good += w * np.array(y)
            for i, j in itertools.pairwise(y):
                trs[i, j] += w
        want[a:b] = good / total
        want_pairs += trs / total
        want_z += np.log(total)
    assert np.allclose(p, want) and np.allclose(pairs, want_pairs) and np.isclose(log_z, want_z)


def test_neighbours_enter_the_features():
    x, n = c.line_features("one two\n### $$$\nthree")
    assert x.shape == (3, c.WIDTH) and n.tolist() == [8, 8, 6]
    assert np.allclose(x[0, 2 * c.OWN:3 * c.OWN], x[1, :c.OWN]) and np.allclose(x[2, c.OWN:2 * c.OWN], x[1, :c.OWN])
    assert not x[0, c.OWN:2 * c.OWN].any()


def test_held_out_accuracy(spark):
    d = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{d}/labels.parquet")
    out = c.line_crf_quality(spark.read.parquet(f"{d}/documents.parquet"), labels)
    rows = out.join(labels, "doc_id").where("held_out").collect()
    assert len(rows) > 50 and np.mean([r.predicted == r.quality for r in rows]) > 0.95
    good, bad = [r.score for r in rows if r.quality == 1], [r.score for r in rows if r.quality == 0]
    assert np.mean([g > b for g in good for b in bad]) > 0.97
    for r in rows[:20]:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)


def test_blocks_do_not_change_scores(docs, monkeypatch):
    model = {"emit": np.linspace(-1, 1, c.WIDTH), "trans": np.array([[1.0, -1], [-1, 1]]), "odds": (0, 1)}
    texts = [r.text for r in docs.limit(30).collect()]
    whole = list(c.score_texts(iter(texts), model))
    monkeypatch.setattr(c, "BLOCK_LINES", 7)
    assert np.allclose(whole, list(c.score_texts(iter(texts), model))) and len(whole) == 30


def test_odd_rows_and_odd_labels(spark, odd, none):
    labels = spark.createDataFrame([(i, i % 2, 0, "x") for i in range(12)] + [(3, None, None, None), (None, 1, 0, ""), (5, 1, 0, ""), (5, 1, 0, "")],
                                   "doc_id long, quality int, toxic int, text string")
    out = c.line_crf_quality(odd, labels).collect()
    assert len(out) == odd.count() and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in out)
    empty = {r.score for r in out if r.doc_id in (0, 1)}
    assert len(empty) == 1
    assert c.line_crf_quality(none, labels).count() == 0
    assert {r.score for r in c.line_crf_quality(odd, labels.limit(0)).collect()} == {0.5}


@pytest.mark.parametrize("text", ["", "\n", "a\n" * 4000, "x" * 100_000])
def test_any_text_scores(text):
    model = {"emit": np.ones(c.WIDTH), "trans": np.ones((2, 2)), "odds": (0, 1)}
    (s,) = c.score_texts(iter([text]), model)
    assert 0 <= s <= 1


def test_long_training_documents_give_neighbouring_lines():
    text = "\n".join(f"line {i} " + "word " * (i % 7) for i in range(300))
    x, n = c.line_features(text)
    some, sizes = c.training_run(text)
    starts = [i for i in range(len(x) - c.TRAIN_LINES + 1) if np.array_equal(x[i:i + c.TRAIN_LINES], some)]
    assert len(some) == c.TRAIN_LINES and starts and np.array_equal(n[starts[0]:starts[0] + c.TRAIN_LINES], sizes)
    assert len(c.training_run("one\ntwo")[0]) == 2


def test_repeated_training_rows_count_once(spark):
    docs = spark.createDataFrame([(i, f"good text {i}" if i % 2 else f"bad ### text {i}") for i in range(12)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(12)], "doc_id long, quality int")
    once, often = c.train(docs, labels), c.train(docs.union(docs).union(docs), labels)
    assert np.array_equal(once["emit"], often["emit"]) and once["odds"] == often["odds"]
