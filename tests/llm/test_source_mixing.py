from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from billow.llm import source_mixing as m

WEIGHTS = {(1, 0): 0.9, (1, 1): 0.04, (0, 0): 0.05, (0, 1): 0.01}
SF = "/root/testdata/sf0.01"


def tables(spark, sf=SF):
    return spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")


def expected(rows):
    total = defaultdict(float)
    for r in rows:
        for domain, p in r.posterior.items():
            total[domain] += r.rate * r.tokens * p
    return total


def test_expected_totals_match_the_targets(spark):
    docs, labels = tables(spark)
    rows = m.mixing_rates(docs, labels, WEIGHTS).collect()
    assert len(rows) == docs.count() and all(r.rate >= 0 and abs(sum(r.posterior.values()) - 1) < 1e-6 for r in rows)
    tokens = sum(r.tokens for r in rows)
    assert tokens == sum(len(r.text.encode().split()) for r in docs.collect())
    got = expected(rows)
    for domain, w in WEIGHTS.items():
        assert got[m.domain_name(domain)] / tokens == pytest.approx(w, abs=0.01)


def test_classifier_knows_the_domains(spark):
    docs, labels = tables(spark, "/root/testdata/sf0.1")
    rows = m.mixing_rates(docs, labels.where("doc_id % 2 = 0"), WEIGHTS).join(labels.where("doc_id % 2 = 1"), "doc_id").collect()
    right = np.mean([r.domain == m.domain_name((r.quality, r.toxic)) for r in rows])
    assert len(rows) > 100 and right > 0.8
    assert np.mean([r.domain.startswith(f"quality{r.quality}") for r in rows]) > 0.9


def test_descent_equals_brute_force(spark):
    rng = np.random.default_rng(0)
    cell = rng.integers(0, 20, (60, 3)) + np.array([[30, 0, 0]]) * (np.arange(60)[:, None] % 2)
    tokens = rng.integers(1, 100, 60)
    cells = spark.createDataFrame([(list(map(int, c)), int(n)) for c, n in zip(cell, tokens)], "cell array<long>, tokens long").coalesce(2)
    p = cell / cell.sum(1, keepdims=True)
    total = float(tokens.sum())
    for target, top in ((np.array([0.5, 0.3, 0.2]), None), (np.array([0.9, 0.05, 0.0]), None), (np.array([0.1, 0.1, 0.8]), 1.0)):
        steps = m.descend(cells, target * total, total, top)
        r = m.final_rates(p, steps, top)
        gram = (p.T @ (p * tokens[:, None])) / total
        w = np.linalg.inv(gram + 1e-4 * np.eye(3))
        x = np.minimum(np.ones(60), 1)
        for _ in range(20_000):  # plain projected gradient
            x = np.clip(x - 0.5 * p @ (w @ ((p * (x * tokens)[:, None]).sum(0) / total - target)), 0, np.inf if top is None else top)
        loss = lambda y: (lambda e: e @ w @ e)((p * (y * tokens)[:, None]).sum(0) / total - target)
        assert (r >= 0).all() and (top is None or (r <= top).all()) and loss(r) <= loss(x) + 1e-5


def test_rate_bound_keeps_what_is_wanted(spark):
    docs, labels = tables(spark)
    rows = m.mixing_rates(docs, labels, {(1, 0): 1.0}, max_rate=1.0).collect()
    sure = [r.rate for r in rows if r.posterior["quality1_toxic0"] > 0.95]
    junk = [r.rate for r in rows if r.posterior["quality1_toxic0"] < 0.05]
    assert sure and junk and min(sure) == 1 and max(junk) < 0.2


def test_copies_follow_the_rate(spark):
    df = spark.range(20_000).select(m.copies(F.lit(1.25), F.col("id"), F.col("id")).alias("c"), m.copies(F.lit(0.0), F.col("id"), F.col("id")).alias("z"))
    got = df.groupBy("c").count().collect()
    assert {r.c for r in got} == {1, 2} and abs(sum(r.c * r["count"] for r in got) / 20_000 - 1.25) < 0.02
    assert df.where("z <> 0").isEmpty()


def test_odd_rows(spark, odd, none):
    labels = spark.createDataFrame([(i, i % 2, i % 3 % 2, "x") for i in range(12)] + [(3, None, 1, None), (None, 1, 0, ""), (5, 1, 0, ""), (5, 1, 0, "")],
                                   "doc_id long, quality int, toxic int, text string")
    rows = m.mixing_rates(odd, labels, WEIGHTS).collect()
    assert len(rows) == odd.count() and all(np.isfinite(r.rate) and r.rate >= 0 for r in rows)
    assert m.mixing_rates(none, labels, WEIGHTS).count() == 0
    assert {r.rate for r in m.mixing_rates(odd, labels.limit(0), WEIGHTS).collect()} == {1.0}


def test_rare_domains_meet_their_targets(spark):
    """Relative error of each domain's expected total, by the documents' own posteriors."""
    docs, labels = tables(spark, "/root/testdata/sf0.1")
    rows = m.mixing_rates(docs, labels, WEIGHTS).collect()
    tokens, got = sum(r.tokens for r in rows), expected(rows)
    share = {w: got[m.domain_name(w)] / tokens for w in WEIGHTS}
    print(share)
    for domain, w in WEIGHTS.items():
        assert share[domain] == pytest.approx(w, rel=0.01), share
