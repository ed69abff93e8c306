import random
import re
import zlib
from collections import Counter

import pytest

from billow.llm import spelling_groups as m

FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def apart_by_one(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute(rows, typo=31, min_length=7, min_count=2, ratio=10):
    counts = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(FOLD)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            counts[run[:h % len(run)] + run[h % len(run) + 1:] if h % typo == 0 else run] += 1
    words = {w: n for w, n in counts.items() if len(w) >= min_length and n >= min_count}
    out, forms = {}, {}
    for w, n in words.items():
        near = [x for x in words if apart_by_one(w, x)]
        best = min(near, key=lambda x: (-words[x], x), default=None)
        forms[w] = best if best is not None and words[best] >= ratio * n else None
        out[w] = (n, len(near))
    result = set()
    for w, (n, near) in out.items():
        root = w
        while forms[root] is not None:
            root = forms[root]
        result.add((w, forms[w], root, n, near, words[forms[w]] if forms[w] else None))
    return result


def got(df):
    rows = df.collect()
    assert len(rows) == len({r.word for r in rows})
    return {(r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in rows}


@pytest.mark.parametrize("letters,lengths", [("ab", (2, 7)), ("abcÿ", (1, 9)), ("aé", (5, 12))])
def test_index_finds_all_words_one_edit_away(letters, lengths):
    rng = random.Random(len(letters) + lengths[1])
    words = list({"".join(rng.choices(letters, k=rng.randint(*lengths))) for _ in range(150)})
    index = m.Index(words)
    queries = {*words, *("".join(rng.choices(letters + "z", k=rng.randint(lengths[0] + 1, lengths[1]))) for _ in range(100))}
    for length in {len(q) for q in queries}:
        some = [q for q in queries if len(q) == length]
        pairs = [(i, j) for by_suffix in (False, True) for i, j in zip(*(x.tolist() for x in index.near(some, by_suffix)))]
        assert len(pairs) == len(set(pairs))
        assert set(pairs) == {(i, j) for i, q in enumerate(some) for j, w in enumerate(words) if apart_by_one(q, w)}


def corpus():
    """Few letters, so that many words are near each other, and a chain of rising counts."""
    rng = random.Random(3)
    words = ["".join(rng.choices("abc", k=rng.randint(6, 9))) for _ in range(120)]
    rows = [(i, " ".join(rng.choices(words, weights=[400 // (k + 1) + 1 for k in range(120)], k=60)).title()) for i in range(60)]
    rows += [(1000 + i, "CAFÉTERIAS,cafétérias-1cafeterias " * 3) for i in range(4)]
    rows += [(2000, "chainxyz " * 2000 + "chainxya " * 150 + "chainxaa " * 12 + "chainaaa"), (2001, ("q" * 600 + " " + "q" * 599 + " ") * 2)]
    return rows + [rows[5], rows[5]]


@pytest.mark.parametrize("block", [30_000, 40])
def test_equals_brute_force(spark, block):
    rows = corpus()
    assert got(m.spelling_groups(spark.createDataFrame(rows, "doc_id long, text string").repartition(7), block=block)) == brute(rows)


def test_given_documents(spark, docs):
    rows = [(r.doc_id, r.text) for r in docs.limit(20).collect()]
    assert got(m.spelling_groups(spark.createDataFrame(rows, "doc_id long, text string"), min_count=1, block=500)) == brute(rows, min_count=1)


def test_odd_rows(spark, odd, none):
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    assert got(m.spelling_groups(odd)) == brute(rows)
    assert got(m.spelling_groups(odd, min_length=1, min_count=1)) == brute(rows, min_length=1, min_count=1)
    assert got(m.spelling_groups(none)) == set()


def test_chains(spark):
    links = spark.createDataFrame([(f"w{i}", f"w{i + 1}") for i in range(11)] + [("x", "w3")], "word string, form string")
    links = m.stored(links, "links")
    assert {(r.word, r.root) for r in m.roots(links).collect()} == {(f"w{i}", "w11") for i in range(11)} | {("x", "w11")}
