"""Hard negatives for labelled vectors, by segment summaries.

Each vector is cut into segments; of a segment its mean and its deviation (the
root of the squared distances from the mean) are kept.  For two vectors a segment of
length l contributes l * mean * mean to the inner product, plus or minus at most
the product of the deviations, so summaries bound the score from both sides.
Bounds are taken on coarse segments first (``LEVELS``), then on the parts of
those segments for the pairs that are left, and exact scores for what still is.  A pair goes
only if its upper bound is below the k-th best lower bound or the window, or its
lower bound is above the window; so results are exact.

Scores are integers: components x become floor(scale * x).  An anchor's positives
are its nearest rows of the same label; its negatives for a positive are the best
rows of another label whose score lies between two percentages of the positive's.

Anchors meet the rows in blocks (every block of anchors with every block of rows;
for positives only blocks of the anchor's label); a block returns k rows of each anchor at most.

Defined results: rows without id or label, with a null or empty vector, with null or
non-finite components, of another length than most (ties: the shorter), or whose scaled components'
squares sum to 2^62 or more (a score would not fit a long) take no part.  Identical
rows are one; rows of one id that differ are rows of their own.  Fewer rows than
asked give shorter lists; a positive score of 0 or below leaves the window as the rule gives it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from billow.llm.common import small, stored

SCALE = 256
#: Segments of each level; the last level's are parts of the first's.
LEVELS = (4, 16)
BLOCK_ROWS = 8192
BLOCK_ANCHORS = 512


def valid(vectors: DataFrame, id_col: str, vector_col: str, label_col: str, scale: int) -> DataFrame:
    """id, label, w (scaled integers) and the 128-bit key of every row that takes part, once each."""
    v = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("long").alias("label"), F.col(vector_col).cast("array<double>").alias("v"))
    # tests in one expression: the planner may put filters in any order
    fits = F.expr(f"""CASE WHEN id IS NULL OR label IS NULL OR v IS NULL OR size(v) < 1 OR exists(v, x -> x IS NULL) THEN false
        WHEN exists(v, x -> isnan(x) OR abs(x) = double('Infinity')) THEN false
        ELSE aggregate(v, 0D, (s, x) -> s + ({scale} * abs(x) + 1) * ({scale} * abs(x) + 1)) < 4.6e18D END""")
    v = v.withColumn("w", F.when(fits, F.expr(f"transform(v, x -> floor({scale} * x))"))).where("w IS NOT NULL").drop("v")
    usual = v.groupBy(F.size("w").alias("n")).count().orderBy(F.desc("count"), "n").first()
    v = v.where(F.size("w") == (usual.n if usual else 0))
    v = v.withColumns({"k1": F.xxhash64("id", "label", "w"), "k2": F.xxhash64(F.lit(1), "id", "label", "w")})
    return v.dropDuplicates(["k1", "k2"])


class Block:
    """Rows of integers with the summaries of their segments on every level."""

    def __init__(self, rows: list, levels: tuple[int, ...] = LEVELS) -> None:
        self.x = np.array([np.asarray(r) for r in rows], np.int64).reshape(len(rows), -1)
        real, dim = self.x.astype(float), self.x.shape[1]
        self.norms = np.sqrt((real * real).sum(1))
        self.sums = []
        for segments in levels:
            cuts = np.unique(np.arange(segments) * dim // segments)
            width = np.diff(np.r_[cuts, dim])
            mean = np.add.reduceat(real, cuts, 1) / width
            apart = real - np.repeat(mean, width, 1)
            self.sums.append((mean * np.sqrt(width), np.sqrt(np.add.reduceat(apart * apart, cuts, 1))))

    def bounds(self, level: int, of: Block, i: int, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(lower, upper) bound of the scores of rows ``at`` with row i of ``of``; rounding is added to both."""
        (mean, apart), (own_mean, own_apart) = self.sums[level], of.sums[level]
        middle, reach = mean[at] @ own_mean[i], apart[at] @ own_apart[i]
        reach += 1 + 1e-9 * self.norms[at] * of.norms[i]
        return middle - reach, middle + reach

    def scores(self, of: Block, i: int, at: np.ndarray) -> np.ndarray:
        return self.x[at] @ of.x[i]


def best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k largest scores, ties by smaller ids."""
    if len(scores) > k:
        at = np.flatnonzero(scores >= np.partition(scores, len(scores) - k)[len(scores) - k])
    else:
        at = np.arange(len(scores))
    return at[np.lexsort((ids[at], -scores[at]))][:k]


def search(block: Block, ids: np.ndarray, of: Block, i: int, at: np.ndarray, k: int, windows: list[tuple[float, float]]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each window (scores from, to) the rows among ``at`` with the k best scores in it, and those scores."""
    wanted = [np.ones(len(at), bool) for _ in windows]
    for level in range(len(block.sums)):
        lower, upper = block.bounds(level, of, i, at)
        for w, (least, most) in enumerate(windows):
            wanted[w] &= (upper >= least) & (lower <= most)
            sure = lower[wanted[w] & (lower >= least) & (upper <= most)]
            if len(sure) > k:
                wanted[w] &= upper >= np.partition(sure, len(sure) - k)[len(sure) - k]
        left = np.logical_or.reduce(wanted)
        at, wanted = at[left], [x[left] for x in wanted]
    scores = block.scores(of, i, at)
    for w, (least, most) in enumerate(windows):
        mine = np.flatnonzero(wanted[w] & (scores >= least) & (scores <= most))
        mine = mine[best(scores[mine], ids[at[mine]], k)]
        yield at[mine], scores[mine]


def nearest_alike(rows: DataFrame, anchors: DataFrame, k: int) -> DataFrame:
    """k1, k2 of the anchor, id, score, rank: its k best other rows of the same label."""
    sizes = small(stored(rows.groupBy("label").agg(F.ceil(F.count("*") / BLOCK_ROWS).alias("blocks"))
                         .join(anchors.groupBy("label").agg(F.ceil(F.count("*") / BLOCK_ANCHORS).alias("anchor_blocks")), "label"), "neg_labels"))
    spread = lambda n: F.explode(F.expr(f"sequence(0L, {n} - 1L)"))
    left = rows.join(sizes, "label").withColumn("block", F.expr("pmod(k2, blocks)")).withColumn("anchor_block", spread("anchor_blocks"))
    right = anchors.join(sizes, "label").withColumn("anchor_block", F.expr("pmod(k2, anchor_blocks)")).withColumn("block", spread("blocks"))

    def meet(some: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(some) and len(asked):
            block, of, ids = Block(some.w.tolist()), Block(asked.w.tolist()), some.id.to_numpy()
            keys = some.k1.to_numpy(), some.k2.to_numpy()
            for i, (k1, k2) in enumerate(zip(asked.k1, asked.k2)):
                others = np.flatnonzero((keys[0] != k1) | (keys[1] != k2))
                for at, scores in search(block, ids, of, i, others, k, [(-np.inf, np.inf)]):
                    out += [(k1, k2, a, s) for a, s in zip(ids[at].tolist(), scores.tolist())]
        return pd.DataFrame(out, columns=["k1", "k2", "id", "score"]).astype("int64")

    keep = ["label", "block", "anchor_block", "id", "k1", "k2", "w"]
    groups = left.select(keep).groupBy("label", "block", "anchor_block"), right.select(keep).groupBy("label", "block", "anchor_block")
    found = groups[0].cogroup(groups[1]).applyInPandas(meet, "k1 long, k2 long, id long, score long")
    return ranked(found, ["k1", "k2"], k)


def ranked(found: DataFrame, of: list[str], k: int) -> DataFrame:
    order = Window.partitionBy(*of).orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def hard_negatives(vectors: DataFrame, every: int = 100, positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90, scale: int = SCALE,
                   relabel: int | None = None, labels: int = 10, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    Anchors are rows whose id is divisible by ``every``; low and high are percentages of the positive's score.
    relabel: rows whose id is divisible by it take the next of ``labels`` labels first."""
    rows = valid(vectors, id_col, vector_col, label_col, scale)
    if relabel:
        rows = rows.withColumn("label", F.when(F.col("id") % relabel == 0, (F.col("label") + 1) % labels).otherwise(F.col("label")))
    rows = stored(rows, "neg_rows")
    anchors = stored(rows.where(F.col("id") % every == 0), "neg_anchors")
    alike = nearest_alike(rows, anchors, positives)
    # at most ``positives`` entries of one anchor come together
    lists = alike.groupBy("k1", "k2").agg(F.array_sort(F.collect_list(F.struct("rank", "id", "score"))).alias("good"))
    asked = stored(anchors.join(lists, ["k1", "k2"]), "neg_asked")
    blocks, anchor_blocks = max(1, -(-rows.count() // BLOCK_ROWS)), max(1, -(-asked.count() // BLOCK_ANCHORS))
    left = rows.withColumn("block", F.expr(f"pmod(k2, {blocks})")).withColumn("anchor_block", F.expr(f"explode(sequence(0L, {anchor_blocks - 1}L))"))
    right = asked.withColumn("anchor_block", F.expr(f"pmod(k2, {anchor_blocks})")).withColumn("block", F.expr(f"explode(sequence(0L, {blocks - 1}L))"))

    def meet(some: pd.DataFrame, of_block: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(some) and len(of_block):
            block, of, ids, label = Block(some.w.tolist()), Block(of_block.w.tolist()), some.id.to_numpy(), some.label.to_numpy()
            for i, (k1, k2, anchor, own, good) in enumerate(zip(of_block.k1, of_block.k2, of_block.id, of_block.label, of_block.good)):
                # whole scores s with low * p <= 100 * s <= high * p
                windows = [(-(-low * int(g["score"]) // 100), high * int(g["score"]) // 100) for g in good]
                for g, (at, scores) in zip(good, search(block, ids, of, i, np.flatnonzero(label != own), negatives, windows)):
                    out += [(k1, k2, g["rank"], anchor, g["id"], g["score"], a, s) for a, s in zip(ids[at].tolist(), scores.tolist())]
        return pd.DataFrame(out, columns=["k1", "k2", "place", "anchor_id", "positive_id", "positive_score", "id", "score"]).astype("int64")

    found = left.groupBy("block", "anchor_block").cogroup(right.groupBy("block", "anchor_block")).applyInPandas(
        meet, "k1 long, k2 long, place long, anchor_id long, positive_id long, positive_score long, id long, score long")
    return ranked(found, ["k1", "k2", "place"], negatives).select(
        "anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
