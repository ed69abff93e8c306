import math
import re
from collections import Counter

import numpy as np
import pytest

from billow.llm import quality_rules as q

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_base(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    grams = [tuple(words[i:i + 5]) for i in range(len(words) - 4)]
    seen = Counter(grams)
    inside = {i + k for i, g in enumerate(grams) if seen[g] > 1 for k in range(5)}
    n = len(words)
    return (n, sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(inside),
            n < 10 or 100 * len(inside) > 20 * n, sum(c.isupper() and c.upper() == c and "Lu" == __import__("unicodedata").category(c) for c in text), len(lines))


def base_of(row):
    return (row.n_words, row.word_chars, row.n_symbols, row.n_dup_lines, row.n_repeat_words, row.base_failed)


def moments(x):
    x = np.hstack([np.ones((len(x), 1)), x])
    return x.T @ x


def brute_kept(rows, prior=q.PRIOR_ROWS):
    """rows: (key, lang, source, text).  The same concentration steps in numpy."""
    f, base, by, fit, d2 = {}, {}, {}, {}, {}
    for key, lang, source, text in rows:
        n, chars, symbols, dup, rep, failed, upper, lines = base[key] = brute_base(text)
        f[key] = [math.log((chars + 250) / (n + 50)), math.sqrt(symbols / (chars + 250)), math.sqrt(upper / (chars + 250)),
                  dup / (lines + 10), rep / (n + 50)]
        by.setdefault((lang, source), []).append(key)
    floor = np.array(list(q.FEATURES.values()))
    for g, keys in by.items():
        x = np.array([f[k] for k in keys if not base[k][5]])
        if len(x):
            fit[g] = x
            d2[g] = (((x - np.sort(x, axis=0)[math.ceil(len(x) / 2) - 1]) / floor) ** 2).sum(1)

    def distance(m, x):
        mean = m[0, 1:] / m[0, 0]
        cov = q.consistency() * (m[1:, 1:] / m[0, 0] - np.outer(mean, mean)) + np.diag(floor ** 2)
        return np.einsum("ij,jk,ik->i", x - mean, np.linalg.inv(cov), x - mean)

    for _ in range(q.STEPS + 1):
        own, lang = {}, {}
        for g, x in fit.items():
            bins = np.floor(np.log2(np.maximum(d2[g], 1e-9)) * q.BINS)
            own[g] = moments(x[bins <= np.sort(bins)[math.ceil(len(bins) * q.H_SHARE) - 1]])
            lang[g[0]] = lang.get(g[0], 0) + own[g]
        corpus = sum(lang.values())
        lean = {k: (m + prior * corpus / corpus[0, 0]) / (m[0, 0] + prior) for k, m in lang.items()}
        model = {g: m + prior * lean[g[0]] for g, m in own.items()}
        d2 = {g: distance(model[g], x) for g, x in fit.items()}
    return {k: not base[k][5] and distance(model[g], np.array([f[k]]))[0] <= q.CUTOFF for g, keys in by.items() for k in keys}


def test_base_counts(docs, odd):
    for df in (docs, odd):
        got = Counter((r.doc_id, *base_of(r)) for r in q.quality_rules(df).collect())
        assert got == Counter((r.doc_id, *brute_base(r.text)[:6]) for r in df.collect())


@pytest.mark.parametrize("prior", [q.PRIOR_ROWS, 5])
def test_outliers_equal_brute_force(docs, prior):
    got = {r.doc_id: r.kept for r in q.quality_rules(docs, prior).collect()}
    want = brute_kept([(r.doc_id, r.lang, r.source, r.text) for r in docs.collect()], prior)
    assert got == want and 0 < sum(got.values()) < len(got)


def test_groups_of_every_size_have_a_verdict(spark):
    """Junk alone in its group, alone in its language and in a large group goes; groups keep their own estimate."""
    prose = lambda i: " ".join([("tiny " if i % 2 else "considerable ") + f"w{i}x{k}" for k in range(40)])
    junk = " ".join(f"W{k}$$$" for k in range(40))
    rows = [(i, prose(i), "en", f"s{i % 2}") for i in range(600)]
    rows += [(1000, junk, "en", "s1"), (1001, junk, "en", "alone"), (1002, junk, "xx", None), (1003, prose(4), "en", "alone too"),
             (1004, None, None, None), (1005, prose(5), None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    got = {r.doc_id: r.kept for r in q.quality_rules(df).collect()}
    assert got == brute_kept([(r[0], r[2], r[3], r[1]) for r in rows])
    assert [got[i] for i in range(1000, 1006)] == [False, False, False, True, False, True] and all(got[i] for i in range(600))


def test_empty_table(none):
    out = q.quality_rules(none)
    assert out.columns[:8] == ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    assert out.count() == 0


def test_quality_labels_agree(spark):
    d = "/root/testdata/sf0.01"
    out = q.quality_rules(spark.read.parquet(f"{d}/documents.parquet")).join(spark.read.parquet(f"{d}/labels.parquet"), "doc_id").collect()
    good, bad = [r.kept for r in out if r.quality == 1], [r.kept for r in out if r.quality == 0]
    assert sum(good) > 0.95 * len(good) and sum(bad) < 0.3 * len(bad)


def test_main_path_is_native(docs):
    for df in (q.base_statistics(docs), q.quality_rules(docs)):
        assert not re.search("Python|Pandas|Arrow", df._jdf.queryExecution().toString())


def test_cutoff_is_the_chi_square_quantile(spark):
    """Documents of sf0.1 beyond the 99.9 % quantile (20.515 in tables) go, those that a cutoff of 50 kept among them."""
    assert abs(q.CUTOFF - 20.515) < 1e-3
    d = "/root/testdata/sf0.1"
    out = q.quality_rules(spark.read.parquet(f"{d}/documents.parquet")).join(spark.read.parquet(f"{d}/labels.parquet"), "doc_id").collect()
    tested = [r for r in out if not r.base_failed]
    assert all(r.kept == (r.distance <= 20.5151) for r in tested)
    assert any(20.52 < r.distance < 50 for r in tested)
    bad, good = [r.kept for r in out if r.quality == 0], [r.kept for r in out if r.quality == 1]
    print("quality 0 kept", sum(bad), "of", len(bad), "quality 1 rejected", len(good) - sum(good), "of", len(good))
    assert sum(bad) <= 10 < len(bad) and sum(good) > 0.95 * len(good)


def test_each_step_reads_the_rows_once(docs, monkeypatch):
    """The first step reads them for the medians too; plans that read them for each use grow the driver's memory."""
    plans, keep = [], q.stored
    monkeypatch.setattr(q, "stored", lambda df, name: plans.append(df._jdf.queryExecution().optimizedPlan().toString()) or keep(df, name))
    q.quality_rules(docs)
    reads = [sum("Relation [" in x and "n_repeat_words#" in x for x in p.split("\n")) for p in plans[1:]]
    assert reads == [2] + [1] * q.STEPS
