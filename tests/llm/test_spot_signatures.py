import hashlib
import random
import re

import pytest

import __spark_entry__ as e
from billow.llm import spot_signatures as m


def signed(text):
    if not text:
        return set()
    words = [w for w in re.split(r"[\W_]+", text.lower()) if w]
    if not words:
        return {hashlib.md5(text.encode()).hexdigest()[:m.DIGITS]}
    chains, anchors, content = [], ["\x01"], []
    for w in words:
        if w in m.COMMON:
            anchors.append(w + "\x01")
        else:
            content.append(("".join(anchors), w))
            anchors = []
    if anchors:
        content.append(("".join(anchors), ""))
    for i, (anchor, _) in enumerate(content):
        if anchor:
            chains.append(" ".join([anchor + content[i][1], *[w for _, w in content[i + 1:i + m.CHAIN]]]))
    return {hashlib.md5(c.encode()).hexdigest()[:m.DIGITS] for c in chains}


def like(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


def brute(rows):
    known = sorted([(i, t or "") for i, t in rows if i is not None], key=lambda r: (-r[0], r[1]))
    out = []
    for k, (i, text) in enumerate(known):
        out.append((i, text, known[(k + 1) % len(known)][1]))
    out += [(None, t or "", "") for i, t in rows if i is None]
    result = []
    for i, text, after in out:
        third = len(text) // 3
        edited = text[:len(text) - third] + after[:third]
        a, b = signed(text), signed(edited)
        result.append((i, len(text), hashlib.sha256(edited.encode()).hexdigest(), "".join(sorted(a)), "".join(sorted(b)),
                       like(a, b), like(a, signed(after)) if i is not None else like(a, set())))
    return sorted(result, key=repr)


def got(df):
    return sorted((tuple(r) for r in df.select("doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next").collect()), key=repr)


@pytest.mark.parametrize("page", [1000, 7, 1])
def test_given_documents(spark, docs, page):
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert got(m.edited_fingerprints(docs.repartition(5), page)) == brute(rows)


@pytest.mark.parametrize("page", [1000, 3])
def test_odd_rows(spark, odd, none, page):
    assert got(m.edited_fingerprints(odd, page)) == brute([(r.doc_id, r.text) for r in odd.collect()])
    assert got(m.edited_fingerprints(none, page)) == []


@pytest.mark.parametrize("page", [1000, 2])
def test_repeated_and_few_ids(spark, page):
    rng = random.Random(page)
    texts = ["the cat of the house and", "The cat of the house AND", "", "...", "alone", "the the the", "of", None, "x the y the z"]
    for rows in ([(5, "only the one text here")], [(rng.choice([1, 2, -7, 2 ** 60, 2 ** 60 + 1]), rng.choice(texts)) for _ in range(40)]):
        assert got(m.edited_fingerprints(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), page)) == brute(rows)


def test_edits_stay_near_and_other_texts_are_far(spark):
    rows = m.edited_fingerprints(spark.read.parquet("/root/testdata/sf0.01/documents.parquet")).where("n_chars > 1000").collect()
    assert sum(r.near_edited for r in rows) / len(rows) > 0.4 and sum(r.near_next for r in rows) / len(rows) < 0.05


@pytest.mark.parametrize("percent, bucket", [(80, 2000), (50, 3)])
def test_near_classes_equal_brute_force(spark, docs, odd, percent, bucket, monkeypatch):
    """All pairs of different sets, over given documents, edits of them, copies, and odd rows."""
    monkeypatch.setattr(m, "BUCKET", bucket)
    rng = random.Random(percent)
    rows = [(r.doc_id, r.text) for r in docs.limit(60).collect()]
    for i, text in rows[:40]:
        words = (text or "").split(" ")
        for k in range(4):
            cut = rng.randrange(len(words))
            rows.append((10_000 + 10 * i + k, " ".join(words[:cut] + words[cut + 1 + k * k:])))
    rows += [(r.doc_id, r.text) for r in odd.collect()] + rows[:5]
    members, pairs = m.near_classes(spark.createDataFrame([(*r, "clash", 1) for r in rows], "doc_id long, text string, key string, n int").repartition(4), percent)
    sets = {}
    for _, text in rows:
        s = frozenset(signed(text or ""))
        sets["".join(sorted(s))] = s
    key = {hashlib.md5(k.encode()).hexdigest(): s for k, s in sets.items()}
    want = {(a, b): like(key[a], key[b]) for a in key for b in key if a < b and key[a] and key[b] and 100 * len(key[a] & key[b]) >= percent * len(key[a] | key[b])}
    assert {(r.a, r.b): r.likeness for r in pairs.collect()} == pytest.approx(want) and len(want) > 50
    got = sorted(((r.doc_id, r.key, r.n) for r in members.collect()), key=repr)
    assert got == sorted(((i, hashlib.md5("".join(sorted(signed(t or ""))).encode()).hexdigest(), len(signed(t or ""))) for i, t in rows), key=repr)


def test_near_classes_of_nothing(none):
    members, pairs = m.near_classes(none)
    assert members.count() == pairs.count() == 0


def test_native_plan(spark):
    plan = e.queries()["op11_spot_signatures"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow|ExistingRDD", plan)
