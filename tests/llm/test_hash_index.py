import math
import random

import numpy as np

from billow.llm import hash_index as h


def brute(rows, every, k):
    ok = [(i, [float(y) for y in v]) for i, v in rows
          if i is not None and v and all(y is not None and math.isfinite(y) for y in v) and any(v)]
    usual = max(sorted({len(v) for _, v in ok}), key=lambda n: sum(len(v) == n for _, v in ok), default=0)
    ok = sorted({(i, tuple(v)) for i, v in ok if len(v) == usual})
    if not ok:
        return {}
    x = np.array([v for _, v in ok])
    x = x / np.linalg.norm(x, axis=1, keepdims=True)
    out = {}
    for q, (i, _) in enumerate(ok):
        if i % every == 0:
            s = x @ x[q]
            out[i] = sorted(((-round(float(s[j]), 12), ok[j][0]) for j in range(len(ok)) if ok[j][0] != i))[:k]
    return out


def run(df, every, k):
    out = {}
    for r in sorted(h.nearest(df, every, k).collect(), key=lambda r: r["rank"]):
        assert r["rank"] == len(out.setdefault(r.query_id, [])) + 1
        out[r.query_id].append((-round(r.score, 12), r.vec_id))
    return out


def recall(got, want):
    assert got.keys() == want.keys()
    return np.mean([len({i for _, i in got[q]} & {i for _, i in want[q]}) / max(1, len(want[q])) for q in want])


def test_recall_on_the_given_vectors(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    want = brute([(r.vec_id, r.embedding) for r in df.collect()], 10, 5)
    got = run(df, 10, 5)
    assert recall(got, want) >= 0.97
    assert all(dict((i, s) for s, i in got[q]).items() <= dict((i, s) for s, i in brute_all).items()
               for q, brute_all in brute([(r.vec_id, r.embedding) for r in df.collect()], 10, 10 ** 6).items())


def test_radius_retrieves_every_code():
    rng = np.random.default_rng(0)
    rows = rng.integers(0, 256, (500, 8), dtype=np.uint8)
    rows[:50] = rows[0] ^ np.packbits(rng.random((50, 64)) < 0.06, axis=1)
    index = h.Index(rows)
    for radius in (0, 3, 7, 8, 15, 20, 40, 64):
        at, apart = index.within(rows[0], radius)
        d = np.unpackbits(rows ^ rows[0], axis=1).sum(1)
        assert at.tolist() == np.flatnonzero(d <= radius).tolist() and apart.tolist() == d[d <= radius].tolist()


def test_copies_ties_and_blocks(spark, monkeypatch):
    monkeypatch.setattr(h, "BLOCK_VECTORS", 40)
    monkeypatch.setattr(h, "BLOCK_QUERIES", 3)
    rng = np.random.default_rng(2)
    common = rng.normal(size=16).astype("float32").tolist()
    rows = [(i, common if i % 3 == 0 else rng.normal(size=16).astype("float32").tolist()) for i in range(240)]
    df = spark.createDataFrame(rows + rows[:9], "vec_id long, embedding array<float>")
    got, want = run(df, 10, 5), brute(rows, 10, 5)
    assert recall(got, want) >= 0.95
    assert got[30] == want[30] and [i for _, i in got[0]] == [3, 6, 9, 12, 15]


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (50, [0.5, 0.5]), (1, None), (2, []), (3, [0.0, 0.0]), (4, [nan, 1.0]), (5, [inf, 1.0]), (6, [None, 1.0]),
            (7, [1.0, 2.0, 3.0]), (None, [1.0, 1.0]), (8, [2.0, 0.0]), (8, [0.0, 1.0]), (100, None), (150, [1e30, 1e30])]
    random.Random(1).shuffle(rows)
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "vec_id long, embedding array<float>, score string, k1 int")
    got = run(df, 50, 5)
    assert got.keys() == {0, 50, 150} and [i for _, i in got[0]] == [8, 50, 150, 8] and [i for _, i in got[50]][0] == 150
    assert run(df.limit(0), 50, 5) == {} == run(df.where("vec_id = 0"), 50, 5)


def test_rows_of_one_id_with_different_vectors_see_each_other(spark):
    df = spark.createDataFrame([(50, [1.0, 0.0]), (50, [1.0, 0.1]), (50, [1.0, 0.0]), (7, [0.0, 1.0])], "vec_id long, embedding array<float>")
    rows = sorted((r.vec_id, round(r.score, 3), r["rank"]) for r in h.nearest(df, 50, 5).collect())
    assert rows == sorted([(50, 0.995, 1), (7, 0.0, 2), (50, 0.995, 1), (7, 0.1, 2)])
