import itertools
import math
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece as spm
from pyspark.sql import functions as F

from billow.llm import piece_sampling as ps

PATH = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def v():
    return ps.vocabulary(PATH)


def paths(v, unit):
    """All segmentations of a unit with their weights, by enumeration."""
    piece = {v.pieces[i]: s for i, s in zip(v.ids, v.scores)}

    def walk(i):
        if i == len(unit):
            yield (), 0.0
        for j in range(i + 1, len(unit) + 1):
            p = unit[i:j]
            if p in piece or (j == i + 1):
                for rest, w in walk(j):
                    yield (p, *rest), w + ps.TEMPERATURE * piece.get(p, v.scores.min())
    got = dict(walk(0))
    total = sum(math.exp(w) for w in got.values())
    return {k: math.exp(w) / total for k, w in got.items()}


@pytest.mark.parametrize("text", ["theing", "añ日", "  a b"])
def test_samples_follow_the_lattice(v, text):
    n = 20_000
    got = Counter()
    for ids in ps.sample_texts(v, [text] * n, np.arange(n, dtype=np.uint64), ps.TEMPERATURE):
        got[tuple(ids)] += 1
    units = [list(paths(v, u).items()) for u in ps.units_of(text)]
    want = Counter()
    index = {v.pieces[i]: int(i) for i in v.ids}
    for combo in itertools.product(*units):
        ids = [i for path, _ in combo for p in path for i in ([index[p]] if p in index else [int(v.bytes[b]) for b in p.encode()])]
        want[tuple(ids)] += math.prod(w for _, w in combo)
    assert set(got) <= set(want)
    assert all(abs(got[k] / n - w) < 0.02 for k, w in want.items())


def test_round_trip_and_reproducible(spark, docs, odd):
    lib = spm.SentencePieceProcessor(model_file=PATH)
    for df in (docs.limit(60), odd):
        coded = ps.decode(ps.encode(df.select("doc_id", "text"), PATH, F.col("doc_id")), PATH, text_col="back")
        rows = coded.collect()
        assert len(rows) == df.count() and all((r.text or "") == r.back for r in rows)
        again = ps.encode(df.repartition(5).select("doc_id", "text"), PATH, F.col("doc_id")).collect()
        assert Counter((r.doc_id, r.text, tuple(r.ids)) for r in rows) == Counter((r.doc_id, r.text, tuple(r.ids)) for r in again)
        for r in rows[:20]:
            if r.text and ps.SPACE not in r.text and "\x00" not in r.text:
                assert lib.decode(list(r.ids)) == r.text
        other = {(r.doc_id, tuple(r.ids)) for r in ps.encode(df.select("doc_id", "text"), PATH, F.col("doc_id"), seed=1).collect()}
        assert other != {(r.doc_id, tuple(r.ids)) for r in rows}


def test_blocks_do_not_change_samples(v, docs, monkeypatch):
    texts = [r.text for r in docs.limit(20).collect()] + ["", "x" * 500, "own ▁ mark ▁▁", "\n\n \n a", "a  b   c"]
    keys = np.arange(len(texts), dtype=np.uint64)
    whole = ps.sample_texts(v, texts, keys, ps.TEMPERATURE)
    monkeypatch.setattr(ps, "BLOCK_CHARS", 50)
    parts = ps.sample_texts(v, texts, keys, ps.TEMPERATURE)
    assert all(np.array_equal(a, b) for a, b in zip(whole, parts))
    assert [ps.decode_ids(v, i) if len(i) else "" for i in whole] == texts


def test_units_of_a_block_share_edges(v, monkeypatch):
    """Lattices are made of 1.6 million characters' distinct units, and of no more than ``LATTICE_CHARS`` characters."""
    made, init = [], ps.Lattice.__init__
    monkeypatch.setattr(ps.Lattice, "__init__", lambda self, v, units, t: made.append(sum(map(len, units))) or init(self, v, units, t))
    texts = [" ".join(f"word{i % 300}" for i in range(1000))] * 150
    keys = np.arange(len(texts), dtype=np.uint64)
    whole = ps.sample_texts(v, texts, keys, ps.TEMPERATURE)
    assert sum(map(len, texts)) > 1_000_000 and len(made) == 1
    made.clear()
    monkeypatch.setattr(ps, "LATTICE_CHARS", 100)
    parts = ps.sample_texts(v, texts[:3] + ["x" * 90 + f" y{i}" for i in range(5)], np.arange(8, dtype=np.uint64), ps.TEMPERATURE)
    assert len(made) > 4 and all(np.array_equal(a, b) for a, b in zip(whole[:3], parts))


def test_long_unit(v):
    text = "a" * 30_000
    (ids,) = ps.sample_texts(v, [text], np.zeros(1, np.uint64), ps.TEMPERATURE)
    assert ps.decode_ids(v, ids) == text


def test_empty_table(none):
    assert ps.decode(ps.encode(none, PATH, F.col("doc_id")), PATH, text_col="back").count() == 0


def test_round_trip_equals_encode_and_decode(spark, odd, monkeypatch):
    monkeypatch.setattr(ps, "BLOCK_CHARS", 500)
    docs = odd.select("doc_id", "text", "lang")
    coded = ps.decode(ps.encode(docs, PATH, F.col("doc_id")), PATH, text_col="decoded")
    want = Counter((r.doc_id, r.lang, tuple(r.ids), r.decoded == (r.text or "")) for r in coded.collect())
    got = ps.round_trip(docs, PATH, F.col("doc_id"))
    assert Counter((r.doc_id, r.lang, tuple(r.ids), r.lossless) for r in got.collect()) == want and all(k[3] for k in want)
    assert ps.round_trip(docs.limit(0), PATH, F.col("doc_id")).count() == 0


def test_hashes_that_share_a_slot_are_told_apart():
    v = ps.vocabulary(public_tokenizers.path("piece_bpe_32k.model"))
    assert v.shared > 1
    at, row, begin = v.find(v.hashes)
    assert (at == np.arange(len(v.hashes))).all() and (row == at).all()
    near = v.hashes ^ np.uint64(1)  # same slots, no pieces
    assert len(v.find(near)[0]) == np.isin(near, v.hashes).sum()
    longer = {p[:k] for p in (v.pieces[i] for i in v.ids) for k in range(1, len(p))}
    some = np.array([v.hash_of(p) for p in sorted(longer)[:500]], np.uint64)
    assert len(v.find(some)[2]) == len(some)
