"""Approximate nearest neighbours by multi-index hashing.

Vectors are normalised and turned into binary codes by learned rotations (each
fitted by iterative quantisation on at most ``FIT_ROWS`` vectors, the ones with
the smallest id hashes).  A code is cut into one-byte substrings, each with an
index of its own.  By the pigeonhole principle every code within Hamming radius
r of a query lies within floor(r / substrings) of it in some substring, so
probing those buckets retrieves the whole radius; retrieved codes outside the
radius are dropped, and the rest are ranked by exact cosine in double precision.

The radius is set per query and block: a first one that retrieves ``FIRST``
codes gives a k-th best cosine; the second is the distance that only a share
``MISS`` of the codes of so near vectors would exceed, by the share of bits that
differ at that angle.  Nothing else limits candidates.

Equal vectors are indexed once, with their k + 1 smallest ids (more cannot enter
a list of k whose ties go to smaller ids, the query's own id included).  Queries
meet the index in blocks: every block of queries with every block of vectors.

Defined results: vectors that are null, empty, all zero, or hold null or
non-finite numbers take no part; so do those of another length than most (ties:
the shorter) and rows without id; of repeated ids with different vectors each is
a candidate, and a query for each; fewer than k candidates give a shorter list.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from statistics import NormalDist

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from billow.llm.common import stored

FIT_ROWS = 20_000
FIT_STEPS = 20
#: Code length in bits; each rotation gives as many bits as the vectors have numbers.
BITS = 256
FIRST = 64
MISS = 0.01
#: Vectors and queries that meet in one task.
BLOCK_VECTORS = 8192
BLOCK_QUERIES = 512
POP8 = np.bitwise_count(np.arange(256, dtype=np.uint8))


def learn(x: np.ndarray, bits: int = BITS, seed: int = 7) -> np.ndarray:
    """(dimension x bits) matrix of rotations, each of least quantisation error on the rows of x."""
    rng, dim, made = np.random.default_rng(seed), x.shape[1], []
    for _ in range(-(-bits // dim)):
        r, _ = np.linalg.qr(rng.normal(size=(dim, dim)))
        for _ in range(FIT_STEPS if len(x) else 0):
            u, _, vt = np.linalg.svd(np.where(x @ r >= 0, 1.0, -1.0).T @ x)
            r = (u @ vt).T
        made.append(r)
    return np.hstack(made)[:, :bits]


def codes(x: np.ndarray, rotations: np.ndarray) -> np.ndarray:
    return np.packbits(x @ rotations >= 0, axis=1)


class Index:
    """Substring tables of one block of codes: for every byte position, rows sorted by that byte."""

    def __init__(self, rows: np.ndarray) -> None:
        self.rows, self.words = rows, np.ascontiguousarray(rows).view(np.uint64)
        self.order = np.argsort(rows, axis=0, kind="stable")
        self.cuts = np.stack([np.searchsorted(rows[self.order[:, j], j], np.arange(257)) for j in range(rows.shape[1])])

    def within(self, code: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
        """(row numbers, distances) of every code within ``radius``."""
        hit = np.zeros(len(self.rows), bool)
        near = radius // self.rows.shape[1]
        for j in range(self.rows.shape[1]):
            if near < 2:
                for value in np.flatnonzero(POP8[np.arange(256) ^ code[j]] <= near):
                    hit[self.order[self.cuts[j, value]:self.cuts[j, value + 1], j]] = True
            else:  # so many buckets are due that their rows are picked in one pass over the substring
                hit |= POP8[self.rows[:, j] ^ code[j]] <= near
            if hit.all():
                break
        at = np.flatnonzero(hit)
        apart = np.bitwise_count(self.words[at] ^ code.view(np.uint64)).sum(1)
        ok = apart <= radius
        return at[ok], apart[ok]


def radius_for(cosine: float, bits: int) -> int:
    """Distance that codes of vectors at this cosine exceed with probability ``MISS``."""
    p = math.acos(max(-1.0, min(1.0, cosine))) / math.pi
    return math.ceil(bits * p + NormalDist().inv_cdf(1 - MISS) * math.sqrt(bits * p * (1 - p)))


def search(index: Index, x: np.ndarray, norms: np.ndarray, ids: list, q: np.ndarray, code: np.ndarray, k: int) -> list[tuple[float, int, int]]:
    """The k best (cosine, id, row) of one block for one query vector, best first, ties to smaller ids."""
    q_norm, bits = math.sqrt(float(q @ q)), 8 * index.rows.shape[1]

    def ranked(at: np.ndarray) -> list[tuple[float, int, int]]:
        cosine = (x[at] * q).sum(1) / (norms[at] * q_norm)
        if len(at) > k:
            keep = cosine >= np.partition(cosine, len(at) - k)[len(at) - k]
            at, cosine = at[keep], cosine[keep]
        return sorted(((c, i, r) for c, r in zip(cosine.tolist(), at) for i in ids[r]), key=lambda y: (-y[0], y[1]))[:k]

    radius = step = max(1, bits // 32)
    at, _ = index.within(code, radius)
    while len(at) < min(FIRST, len(x)):
        step *= 2
        radius = min(bits, radius + step)
        at, _ = index.within(code, radius)
    best = ranked(at)
    enough = radius_for(best[-1][0], bits) if len(best) == k else bits
    return ranked(index.within(code, enough)[0]) if enough > radius else best


def valid(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """id, vector of doubles and its 128-bit key, for vectors that take part."""
    v = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("v")).where("id IS NOT NULL AND size(v) > 0")
    v = v.where("forall(v, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < double('Infinity')) AND exists(v, x -> x <> 0)")
    usual = v.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").first()
    v = v.where(F.size("v") == (usual.n if usual else 0))
    return v.withColumns({"k1": F.xxhash64("v"), "k2": F.xxhash64(F.lit(1), "v")})


def nearest(vectors: DataFrame, every: int, k: int = 5, id_col: str = "vec_id", vector_col: str = "embedding", bits: int = BITS) -> DataFrame:
    """query_id, rank, id, score: the k nearest of every vector whose id is divisible by ``every``."""
    rows = stored(valid(vectors, id_col, vector_col), "ann_rows")
    first_ids = rows.dropDuplicates(["k1", "k2", "id"]).withColumn(
        "place", F.expr("row_number() OVER (PARTITION BY k1, k2 ORDER BY id)")).where(F.col("place") <= k + 1)
    index = stored(first_ids.groupBy("k1", "k2").agg(F.first("v").alias("v"), F.array_sort(F.collect_list("id")).alias("ids")), "ann_index")
    queries = rows.where(F.col("id") % every == 0).select("id", "k1", "k2")
    asked = stored(queries.select("k1", "k2").distinct().join(index, ["k1", "k2"]).select("k1", "k2", "v"), "ann_asked")
    n, n_asked = index.count(), asked.count()
    blocks, query_blocks = max(1, -(-n // BLOCK_VECTORS)), max(1, -(-n_asked // BLOCK_QUERIES))
    sample = index.orderBy(F.xxhash64("k1"), "k1", "k2").limit(FIT_ROWS).select("v").toPandas()
    if sample.empty:
        return vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    x = np.array(sample.v.tolist(), float)
    rotations = learn(x / np.abs(x).max(1, keepdims=True) / np.linalg.norm(x / np.abs(x).max(1, keepdims=True), axis=1, keepdims=True), bits)

    def prepared(pdf: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
        v = np.array(pdf.v.tolist(), float)
        v /= np.abs(v).max(1, keepdims=True)  # no overflow in squares; the cosine stays
        return v, codes(v, rotations)

    def meet(vs: pd.DataFrame, qs: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(vs) and len(qs):
            (v, c), (q, qc) = prepared(vs), prepared(qs)
            found, norms, ids = Index(c), np.sqrt((v * v).sum(1)), vs.ids.tolist()
            for k1, k2, a, b in zip(qs.k1, qs.k2, q, qc):
                out += [(k1, k2, s, i, vs.k1[r] == k1 and vs.k2[r] == k2) for s, i, r in search(found, v, norms, ids, a, b, k + 1)]
        return pd.DataFrame(out, columns=["k1", "k2", "score", "id", "same"]).astype({"k1": "int64", "k2": "int64", "score": float, "id": "int64", "same": bool})

    left = index.withColumns({"block": F.expr(f"pmod(xxhash64(k2), {blocks})"), "qblock": F.expr(f"explode(sequence(0L, {query_blocks - 1}L))")})
    right = asked.withColumns({"qblock": F.expr(f"pmod(xxhash64(k2), {query_blocks})"), "block": F.expr(f"explode(sequence(0L, {blocks - 1}L))")})
    found = left.groupBy("block", "qblock").cogroup(right.groupBy("block", "qblock")).applyInPandas(meet, "k1 long, k2 long, score double, id long, same boolean")
    # k + 1 answers of each block at most come together for one query vector
    lists = found.groupBy("k1", "k2").agg(F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("minus"), "id", "same"))).alias("all"))
    own = queries.distinct().join(lists, ["k1", "k2"]).select(
        F.col("id").alias("query_id"), F.expr(f"slice(filter(all, x -> NOT (x.id = id AND x.same)), 1, {k})").alias("best"))
    return own.select("query_id", F.posexplode("best").alias("p", "x")).select(
        "query_id", (F.col("p") + 1).cast("int").alias("rank"), F.col("x.id").alias("vec_id"), (-F.col("x.minus")).alias("score"))
