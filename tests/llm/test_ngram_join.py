import random
import re
import time
from collections import Counter, defaultdict
from itertools import combinations

import numpy as np
import pytest

from billow.llm import ngram_join as j
from billow.llm.components import connected_components

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text, n=4):
    w = WORD.findall((text or "").translate(LOWER))
    return {tuple(w[i:i + n]) for i in range(max(1, len(w) - n + 1))} if w else set()


def brute(rows, percent=85):
    """rows of (doc_id, text) -> (doc_id, set size, smallest doc_id reached)."""
    sets = [shingles(t) for _, t in rows]
    near = defaultdict(set)
    posts = defaultdict(list)
    for i, s in enumerate(sets):
        for g in s:
            posts[g].append(i)
    pairs = Counter()
    for p in posts.values():
        pairs.update(combinations(p, 2))
    for (a, b), both in pairs.items():
        if 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
            near[a].add(b)
            near[b].add(a)
    label = {}
    for i in range(len(rows)):
        if i not in label:
            comp, todo = set(), [i]
            while todo:
                x = todo.pop()
                if x not in comp:
                    comp.add(x)
                    todo.extend(near[x])
            least = min((rows[x][0] for x in comp if rows[x][0] is not None), default=None)
            label |= dict.fromkeys(comp, least)
    return Counter((d, len(s), label[i] if s else d) for i, ((d, _), s) in enumerate(zip(rows, sets)))


def run(df, **more):
    return Counter((r.doc_id, r.n_shingles, r.component_id) for r in j.ngram_jaccard_join(df, **more).collect())


def test_documents(docs):
    got = run(docs)
    assert got == brute([(r.doc_id, r.text) for r in docs.collect()])
    assert any(d != c for d, _, c in got)


def test_odd_rows(odd, none):
    assert run(odd) == brute([(r.doc_id, r.text) for r in odd.collect()])
    out = j.ngram_jaccard_join(none)
    assert out.columns[:3] == ["doc_id", "n_shingles", "component_id"] and out.count() == 0


def variants(seed, copies):
    rng = random.Random(seed)
    rows = []
    for base in range(6):
        words = [f"w{base}x{rng.randrange(400)}" for _ in range(60)]
        for _ in range(copies):
            v = list(words)
            for _ in range(rng.choice([0, 0, 1, 1, 2, 6])):
                v[rng.randrange(len(v))] = f"n{rng.randrange(10 ** 6)}"
            rows.append(" ".join(v[: rng.choice([60, 60, 58, 40])]))
    passage = " ".join(f"common{k}" for k in range(50))
    rows += [passage + " " + " ".join(f"own{rng.randrange(10 ** 6)}" for _ in range(rng.choice([3, 6, 9, 80]))) for _ in range(30)]
    rng.shuffle(rows)
    return list(enumerate(rows))


@pytest.mark.parametrize("run_length, block", [(8, 2000), (3, 4)])
def test_large_groups(spark, monkeypatch, run_length, block):
    """The second case sends nearly all pairs by the way of long runs, block against block."""
    monkeypatch.setattr(j, "RUN", run_length)
    monkeypatch.setattr(j, "BLOCK", block)
    rows = variants(1, 25)
    assert run(spark.createDataFrame(rows, "doc_id long, text string")) == brute(rows)


def test_groups_of_equal_prefixes(spark, monkeypatch):
    """With one counter level and a zero prefix order, sets that differ behind their prefix share a group."""
    monkeypatch.setattr(j, "RUN", 2)
    monkeypatch.setattr(j, "xxhash", type("x", (), dict(vars(j.xxhash), xxh64_digest=staticmethod(lambda p, size: b"\1" * 8))))
    rows = variants(3, 8)
    assert run(spark.createDataFrame(rows, "doc_id long, text string")) == brute(rows)


def test_components(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 101), (101, 100), (100, 100), (7, 7), (300, 200), (200, 250)]
    got = {r.node: r.label for r in connected_components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(41)} | {100: 100, 101: 100, 200: 200, 250: 200, 300: 200}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_stored_tables_hold_texts_not_sets(docs, monkeypatch):
    """Hashes do not compress: a table of sets, shuffled for each side of the pairs, took most of the disk."""
    kept, keep = {}, j.stored
    monkeypatch.setattr(j, "stored", lambda df, name: kept.update({name: df.columns}) or keep(df, name))
    j.ngram_jaccard_join(docs)
    assert kept["ngram_texts"] == ["cid", "text"]


def test_a_stored_tables_shuffles_are_freed(spark):
    blocks = lambda: {b for b in str(spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllBlocks()).split(", ") if "shuffle_" in b and ".data" in b}
    before = blocks()
    out = j.stored(spark.range(1000).selectExpr("id % 7 AS k").groupBy("k").count(), "freed")
    end = time.time() + 10
    while blocks() - before and time.time() < end:
        time.sleep(0.2)
    assert not blocks() - before and out.count() == 7


def test_sketches_bound_the_difference():
    rng = np.random.default_rng(5)
    pool = rng.integers(0, 1 << 63, 40_000).astype(np.uint64)
    assert j.sketch(np.unique(pool[:512])) == b""
    for size, other in [(513, 513), (1000, 1100), (3000, 3000), (5000, 4400), (16_000, 18_000)]:
        a = np.unique(pool[:size])
        near = np.unique(np.r_[pool[:min(size, other) - 30], pool[20_000:20_030 + max(0, other - size)]])
        far = np.unique(pool[20_000:20_000 + other])
        for b, alike in ((a, True), (near, True), (far, False)):
            apart = j.sketches_apart(j.sketch(a), j.sketch(b))
            assert apart == j.sketches_apart(j.sketch(b), j.sketch(a)) <= len(np.setxor1d(a, b))
            total = len(a) + len(b)
            assert (total - 2 * j.needed(np.array([total]), 85)[0] >= apart) == alike


def test_long_texts_that_share_a_passage_are_not_compared(spark, monkeypatch):
    """Bitmaps of 512 bits let every pair of long texts pass, and pairs of long runs came whatever their sizes."""
    rng = random.Random(4)
    words = lambda n: " ".join(f"w{rng.randrange(10 ** 6)}" for _ in range(n))
    passages = [words(60) for _ in range(8)]
    texts = [passages[i // 5] + " " + words(rng.choice([900, 930, 2500])) for i in range(35)]
    texts += [passages[7] + " " + words(size) for size in range(300, 3000, 100)]
    texts += [t + " " + words(k) for t in texts[::9] for k in (20, 200)]
    rows = list(enumerate(texts))
    sets, compared, verify = [shingles(t) for t in texts], [], j.verify

    def seen(pairs, classes, *rest):
        ids = {r.cid: r.doc_id for r in classes.collect()}
        compared.extend((sets[ids[r.a]], sets[ids[r.b]]) for r in pairs.collect())
        return verify(pairs, classes, *rest)

    monkeypatch.setattr(j, "verify", seen)
    assert run(spark.createDataFrame(rows, "doc_id long, text string")) == brute(rows)
    assert compared and all(len(a & b) >= 0.6 * len(a | b) for a, b in compared)
