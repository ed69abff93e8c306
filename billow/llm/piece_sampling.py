"""Sampled segmentations over a SentencePiece vocabulary, and lossless decoding.

A text's pieces form a lattice.  No piece crosses from another character to a
space mark, and characters outside the vocabulary stand alone, so the lattice
falls into units (runs of space marks with what follows).  For the distinct units
of a batch the forward filter sums, over all paths to each node, exp(temperature *
piece score).  Backward sampling then walks from the end of every occurrence of a
unit to its start, choosing the last piece by those sums; all occurrences walk
together, one piece a step.  Each choice is drawn from a hash of (seed, row key,
occurrence, step): a row's segmentation depends on nothing else.

Characters without a piece become their UTF-8 bytes, so decoding the ids gives
back the text, whatever it holds.  Defined results: null and empty texts have no
ids; repeated rows with equal keys have equal segmentations; a null key counts as
the hash of nothing; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Scores of a merge vocabulary are ranks; this makes them log weights (0: all segmentations alike).
TEMPERATURE = 0.0005
#: Characters sampled at a time, so that memory does not follow batch or text size.
BLOCK_CHARS = 1_600_000
#: Characters of distinct units in one lattice: the longer a block, the more of its units are repeats, which cost no new edges.
LATTICE_CHARS = 400_000
SLOT_BITS = 22
SPACE, PLACE = "▁", np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Vocabulary:
    """Pieces by hash of their characters, their scores, and the ids of single bytes."""

    def __init__(self, path: str) -> None:
        import sentencepiece as spm

        sp = spm.SentencePieceProcessor(model_file=path)
        ids = [i for i in range(len(sp)) if not (sp.is_unknown(i) or sp.is_control(i) or sp.is_unused(i) or sp.is_byte(i))]
        self.pieces = [sp.id_to_piece(i) for i in range(len(sp))]
        if any(SPACE in self.pieces[i].lstrip(SPACE) or "\n" in self.pieces[i] for i in ids):
            raise ValueError("a piece holds a space mark after another character, or a line break")
        self.bytes = np.array([sp.piece_to_id(f"<0x{b:02X}>") for b in range(256)], np.int32)
        if any(not sp.is_byte(int(i)) for i in self.bytes):
            raise ValueError("the vocabulary has no byte pieces")
        self.longest = max(len(self.pieces[i]) for i in ids)
        scores = np.array([sp.get_score(i) for i in ids])
        scores = np.where(scores < -1e6, scores[scores > -1e6].min() - 1, scores)  # pieces that merging alone never makes
        hashes = np.array([self.hash_of(self.pieces[i]) for i in ids], np.uint64)
        order = np.argsort(hashes)
        self.hashes, self.ids, self.scores = hashes[order], np.array(ids, np.int32)[order], scores[order]
        # by the first SLOT_BITS of a hash: twice the number of its first row from 1 (0: none), and 1 where a piece may begin so
        self.slots = np.zeros(1 << SLOT_BITS, np.int32)
        slot, first, shared = np.unique(self.slot_of(self.hashes), return_index=True, return_counts=True)
        self.slots[slot], self.shared = 2 * (first + 1), int(shared.max())
        for i in ids:
            for n in range(1, len(self.pieces[i])):
                self.slots[self.hash_of(self.pieces[i][:n]) >> (64 - SLOT_BITS)] |= 1
        raw = [bytes([int(p[1:-1], 16)]) if sp.is_byte(i) else p.replace(SPACE, " ").encode() for i, p in enumerate(self.pieces)]
        self.table = np.frombuffer(b"".join(raw), np.uint8)
        self.sizes = np.fromiter(map(len, raw), np.int64, len(raw))
        self.begin = np.cumsum(self.sizes) - self.sizes

    @staticmethod
    def hash_of(piece: str) -> int:
        h = 0
        for c in piece:
            h = ((h + ord(c) + 1) * int(PLACE)) & (2 ** 64 - 1)
        return int(mix(np.array([h], np.uint64))[0])

    @staticmethod
    def slot_of(h: np.ndarray) -> np.ndarray:
        return (h >> np.uint64(64 - SLOT_BITS)).view(np.int64)

    def find(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(positions in h, rows of the vocabulary) of hashes that are pieces, and positions of those that may begin one."""
        held = self.slots[self.slot_of(h)]
        at = np.flatnonzero(held > 1)
        begin, row, h = np.flatnonzero(held & 1), (held[at] >> 1) - 1, h[at]
        for _ in range(self.shared - 1):  # rows of one slot follow each other
            row += (self.hashes[row] != h) & (row < len(self.hashes) - 1)
        ok = self.hashes[row] == h
        return at[ok], row[ok], begin


@lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


UNIT = re.compile(f"\n|{SPACE}*[^{SPACE}\n]+|{SPACE}+")
#: Stands for a space mark that the text itself holds; it has no piece, so it goes to bytes (no text holds half a surrogate pair).
OWN_MARK = "\ud800"


def units_of(text: str) -> list[str]:
    """The text, with the leading space of the vocabulary's convention, cut into units."""
    return UNIT.findall((" " + text).replace(SPACE, OWN_MARK).replace(" ", SPACE)) if text else []


class Lattice:
    """Edges of the lattices of many units, with cumulative probabilities of the edges that end at each node."""

    def __init__(self, v: Vocabulary, units: list[str], temperature: float) -> None:
        sizes = np.fromiter(map(len, units), np.int64, len(units))
        chars = np.frombuffer("".join(units).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
        self.end = np.cumsum(sizes) + np.arange(len(units))  # a unit of n characters has n + 1 nodes
        self.start = self.end - sizes
        node = np.arange(len(chars)) + np.repeat(np.arange(len(units)), sizes)  # node before each character
        left = np.repeat(np.cumsum(sizes), sizes) - np.arange(len(chars))  # characters to the unit's end
        at, h, begin, length, row = np.arange(len(chars)), np.zeros(len(chars), np.uint64), [], [], []
        for n in range(1, v.longest + 1):
            inside = left[at] >= n
            at, h = at[inside], h[inside]
            h = (h + chars[at + n - 1] + np.uint64(1)) * PLACE
            hit, found, go = v.find(mix(h))
            begin.append(at[hit])
            length.append(np.full(len(hit), n))
            row.append(found)
            at, h = at[go], h[go]
        alone = np.ones(len(chars), bool)
        alone[begin[0]] = False  # has a piece of its own
        bare = np.flatnonzero(alone)
        begin, length = np.concatenate([*begin, bare]), np.concatenate([*length, np.ones(len(bare), np.int64)])
        row = np.concatenate(row)
        score = temperature * np.concatenate([v.scores[row], np.full(len(bare), v.scores.min())])
        # ids of an edge: a slice of self.ids
        texts = [SPACE if c == ord(OWN_MARK) else chr(c) for c in chars[bare].tolist()]
        raws = [t.encode() for t in texts]
        self.ids = np.concatenate([v.ids[row], v.bytes[np.frombuffer(b"".join(raws), np.uint8)]])
        count = np.concatenate([np.ones(len(row), np.int64), np.fromiter(map(len, raws), np.int64, len(raws))])
        first = np.cumsum(count) - count
        source = node[begin]
        target = source + length
        deep = target - np.repeat(self.start, sizes)[begin]  # distance from the unit's start
        a = np.zeros(int(self.end[-1]) + 1 if len(units) else 0)
        # edges of each length come in order of their targets, which a stable sort merges; one order, whatever else is in the block
        by = np.argsort(target * 64 + length, kind="stable")
        depth = deep[by]
        order = by[np.argsort(depth.astype(np.uint16) if len(depth) and depth.max() < 1 << 16 else depth, kind="stable")]
        s, t, w = source[order], target[order], score[order]
        heads = np.flatnonzero(np.r_[True, t[1:] != t[:-1]]) if len(t) else np.empty(0, np.int64)
        levels = np.searchsorted(deep[order][heads], np.arange(1, int(deep.max()) + 2)) if len(t) else []
        for i in range(len(levels) - 1):  # forward filter, all units' nodes at one distance together
            h0, h1 = levels[i], levels[i + 1]
            e0, e1 = heads[h0], heads[h1] if h1 < len(heads) else len(t)
            a[t[heads[h0:h1]]] = np.logaddexp.reduceat(a[s[e0:e1]] + w[e0:e1], heads[h0:h1] - e0)
        self.source, target = source[by].astype(np.int32), target[by].astype(np.int32)
        self.first, self.count = first[by].astype(np.int32), count[by].astype(np.int32)
        # whole numbers, so that a draw depends on its own node alone
        p = np.maximum(1, np.rint(np.exp(a[self.source] + score[by] - a[target]) * (1 << 30))).astype(np.int64)
        total = np.cumsum(p)
        heads = np.flatnonzero(np.r_[True, target[1:] != target[:-1]]) if len(target) else np.empty(0, np.int64)
        inside = total - np.repeat((total - p)[heads], np.diff(np.r_[heads, len(target)]))
        self.cum = inside + (target.astype(np.int64) << 32)
        self.weight = np.zeros(len(a), np.int64)
        self.weight[target] = inside  # of the last edge into each node: all of them

    def sample(self, unit: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all occurrences in order, ids per occurrence), walking all occurrences from end to start."""
        at, walk, stop = np.arange(len(unit)), self.end[unit], self.start[unit]
        taken, steps = [], np.zeros(len(unit), np.int64)
        draw = np.zeros(1, np.uint64)
        while len(at):
            u = (mix(key[at] + draw) >> np.uint64(34)).astype(np.int64) * self.weight[walk] >> 30
            edge = np.searchsorted(self.cum, (walk << 32) + u, "right")
            taken.append((at, edge))
            steps[at] += 1
            walk = self.source[edge].astype(np.int64)
            go = walk > stop[at]
            at, walk, draw = at[go], walk[go], draw + PLACE
        after = np.cumsum(steps)
        edges = np.empty(int(steps.sum()), np.int64)
        for i, (which, edge) in enumerate(taken):
            edges[after[which] - 1 - i] = edge
        count = self.count[edges]
        made = np.cumsum(count)
        ids = self.ids[np.repeat(self.first[edges] - (made - count), count) + np.arange(int(count.sum()))]
        return ids, np.add.reduceat(count, after - steps) if len(unit) else np.zeros(0, np.int64)


def sample_texts(v: Vocabulary, texts: list[str], keys: np.ndarray, temperature: float) -> list[np.ndarray]:
    """Sampled ids of each text, blocks of units at a time."""
    out: list[list[np.ndarray]] = [[] for _ in texts]
    number: dict[str, int] = {}
    unit, key, cuts, chars, new = [], [], [], 0, 0

    def flush() -> None:
        which = np.concatenate(unit)
        ids, count = Lattice(v, list(number), temperature).sample(which, np.concatenate(key))
        ends, seen = np.r_[0, np.cumsum(count)], 0
        for doc, n in cuts:
            out[doc].append(ids[ends[seen]:ends[seen + n]])
            seen += n
        for x in (number, unit, key, cuts):
            x.clear()

    for doc, text in enumerate(texts):
        units = units_of(text)
        step = max(1, BLOCK_CHARS // 32)
        for i in range(0, len(units), step):
            part = units[i:i + step]
            for u in dict.fromkeys(part):
                if u not in number:
                    number[u] = len(number)
                    new += len(u)
            unit.append(np.fromiter(map(number.__getitem__, part), np.int64, len(part)))
            key.append(mix(mix(keys[doc:doc + 1]) + np.arange(i, i + len(part), dtype=np.uint64)))
            cuts.append((doc, len(part)))
            chars += sum(map(len, part))
            if chars >= BLOCK_CHARS or new >= LATTICE_CHARS:
                flush()
                chars = new = 0
    if cuts:
        flush()
    return [np.concatenate(x).astype(np.int32) if x else np.empty(0, np.int32) for x in out]


def encode(df: DataFrame, model_path: str, key: Column, text_col: str = "text", ids_col: str = "ids", seed: int = 0,
           temperature: float = TEMPERATURE) -> DataFrame:
    """``df`` with a column of sampled ids, seeded by the row's key."""

    @F.pandas_udf("array<int>")
    def ids(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        v = vocabulary(model_path)
        for texts, keys in batches:
            yield pd.Series(sample_texts(v, texts.tolist(), keys.to_numpy(np.int64).astype(np.uint64), temperature), dtype=object)

    return df.withColumn(ids_col, ids(F.coalesce(F.col(text_col), F.lit("")), F.xxhash64(F.lit(seed), key)))


def round_trip(df: DataFrame, model_path: str, key: Column, text_col: str = "text", seed: int = 0, temperature: float = TEMPERATURE) -> DataFrame:
    """``df`` without its text, with sampled ``ids`` and ``lossless`` (whether they decode to the text).

    Both in one pass over blocks of ``BLOCK_CHARS`` characters, so a worker holds one block's ids and texts."""

    def both(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        v = vocabulary(model_path)
        for b in batches:
            size = b[text_col].str.len().to_numpy()
            block = np.cumsum(size) // BLOCK_CHARS
            for _, some in b.groupby(block, sort=False):
                texts = some[text_col].tolist()
                ids = sample_texts(v, texts, some["__key"].to_numpy(np.int64).astype(np.uint64), temperature)
                same = [decode_ids(v, x) == t for x, t in zip(ids, texts)]
                yield some[rest].assign(ids=pd.Series(ids, index=some.index, dtype=object), lossless=same)

    rest = [c for c in df.columns if c != text_col]
    kinds = ", ".join(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in rest)
    keyed = df.withColumns({text_col: F.coalesce(F.col(text_col), F.lit("")), "__key": F.xxhash64(F.lit(seed), key)})
    return keyed.mapInPandas(both, f"{kinds}, ids array<int>, lossless boolean")


def decode_ids(v: Vocabulary, ids) -> str:
    ids, parts = np.asarray(ids, np.int64), []
    for i in range(0, len(ids), BLOCK_CHARS):
        some = ids[i:i + BLOCK_CHARS]
        n = v.sizes[some]
        made = np.cumsum(n)
        parts.append(v.table[np.repeat(v.begin[some] - (made - n), n) + np.arange(made[-1])].tobytes())
    return b"".join(parts).decode("utf-8")[1:]


def decode(df: DataFrame, model_path: str, ids_col: str = "ids", text_col: str = "text") -> DataFrame:
    """``df`` with the text of its ids (null ids: null)."""

    @F.pandas_udf("string")
    def text(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        v = vocabulary(model_path)
        for b in batches:
            yield pd.Series([None if x is None else decode_ids(v, x) for x in b], dtype=object)

    return df.withColumn(text_col, text(ids_col))
