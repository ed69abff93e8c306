"""Document quality from a linear-chain conditional random field over lines.

Every line of a text is a node labelled good or bad.  A node sees statistics of
its own line and of the lines before and after it; edges hold the label
transitions.  Training lines take the label of their document (weak labels) and
the conditional likelihood is maximised on at most ``TRAIN_DOCS`` labelled
documents, chosen evenly by a hash of their id; of one with more than
``TRAIN_LINES`` lines, a run of so many neighbouring lines from a place that the
text's hash names (scores take every line of every text).  A document's score is the mean
of its lines' forward-backward marginals for "good", weighted by line length, put
on the scale of a probability by a one-variable logistic fit to the labels of
the same training documents.

Only the text enters a score.  Defined results: null and empty texts are one
empty line and get that line's score; repeated rows are scored alike, each in
its place; of a training document's repeated rows that with the smallest text
hash counts; where no labelled training document exists, every score is 0.5; an
empty table gives an empty result.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from billow.llm.common import fold, id_and_text, one_text_each

#: Labelled documents to learn from, at most (the sample's documented bound), and lines of one of them.
TRAIN_DOCS = 3000
TRAIN_LINES = 64
FOLDS = 5
THRESHOLD = 0.3
#: Feature rows scored at a time, so that memory follows neither text nor batch size.
BLOCK_LINES = 50_000
OWN = 17
WIDTH = 3 * OWN + 2
SYMBOLS, STOPS = b"#*$%&|<>", b".,;:!?"
UPPER, DIGITS, SPACE = bytes(range(65, 91)), bytes(range(48, 58)), b" \t\n\x0b\x0c\r"


def share_of(raw: bytes, kinds: bytes) -> float:
    return (len(raw) - len(raw.translate(None, kinds))) / (len(raw) + 1)


def line_features(text: str) -> tuple[np.ndarray, np.ndarray]:
    """(lines x WIDTH features, line lengths) of one text."""
    raws = text.encode("utf-8", "replace").split(b"\n")
    own = np.zeros((len(raws) + 2, OWN), dtype=np.float32)
    times: dict[bytes, int] = {}
    for raw in raws:
        times[raw] = times.get(raw, 0) + 1
    for i, raw in enumerate(raws, 1):
        n, words = len(raw), raw.split()
        m = len(words)
        symbols, upper, kinds = share_of(raw, SYMBOLS), share_of(raw, UPPER), len(set(words)) / (m + 1)
        pairs = (len(set(zip(words, words[1:]))) + 1) / m if m > 1 else 1
        own[i] = (1, np.log1p(n) / 8, symbols, upper, share_of(raw, DIGITS), share_of(raw, STOPS), (n - m) / (10 * m + 10),
                  kinds, pairs, m == 0, times[raw] > 1 and m > 0, min(m, 20) / 20,
                  symbols > 0.03, upper > 0.3, m > 4 and kinds < 0.4, m > 4 and pairs < 0.6,
                  m > 4 and sum(map(bytes.__eq__, words, words[1:])) > 0.2 * m)
    ends = np.zeros((len(raws), 2), dtype=np.float32)
    ends[0, 0] = ends[-1, 1] = 1
    return np.hstack([own[1:-1], own[:-2], own[2:], ends]), np.fromiter((len(r) + 1 for r in raws), float)


def marginals(emit: np.ndarray, trans: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """Forward-backward over all chains at once.

    emit: (lines,) log odds of "good"; trans: (2, 2) log weights; starts: first line of each chain and the
    end.  Returns each line's P(good), the expected count of each transition, and the log normaliser."""
    lengths = np.diff(starts)
    order = np.argsort(-lengths, kind="stable")
    first, lengths = starts[:-1][order], lengths[order]
    score = np.stack([np.zeros_like(emit), emit], 1)
    top = score.max(1, keepdims=True)
    phi, t = np.exp(score - top), np.exp(trans)
    alpha, scale = np.empty_like(phi), np.empty(len(emit))
    for k in range(lengths[0]):
        at = first[:np.searchsorted(-lengths, -k, "left")] + k
        a = phi[at] * (alpha[at - 1] @ t) if k else phi[at]
        scale[at] = a.sum(1)
        alpha[at] = a / scale[at, None]
    beta = np.ones_like(phi)
    pairs = np.zeros((2, 2))
    for k in range(lengths[0] - 2, -1, -1):
        at = first[:np.searchsorted(-lengths, -(k + 1), "left")] + k
        after = phi[at + 1] * beta[at + 1] / scale[at + 1, None]
        beta[at] = after @ t.T
        pairs += (alpha[at].T @ after) * t
    return (alpha * beta)[:, 1], pairs, float(np.log(scale).sum() + top.sum())


def calibrate(mean: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """(intercept, slope), from a grid, of the most likely logistic fit of labels to the log odds of mean marginals."""
    z, sign = log_odds(mean), 1 - 2 * y
    grid = [(a, b) for b in (0.5, 1.0, 1.5, 2.0, 3.0) for a in np.arange(-10, 10.1, 0.25)]
    return min(grid, key=lambda w: np.logaddexp(0, sign * (w[0] + w[1] * z)).sum() + 0.01 * w[0] ** 2)


def log_odds(p: np.ndarray) -> np.ndarray:
    p = np.clip(p, 1e-6, 1 - 1e-6)
    return np.log(p / (1 - p))


def fit(chains: list[tuple[np.ndarray, np.ndarray, int]], rounds: int = 150, ridge: float = 1e-2) -> dict:
    """Weights that maximise the mean conditional log likelihood per line (Adam on the exact gradient, over
    standardised features), and the calibration.  chains: (features, line lengths, label) of documents."""
    sizes = np.concatenate([n for _, n, _ in chains]).astype(float)
    labels = np.array([label for _, _, label in chains], float)
    chains = [(c, label) for c, _, label in chains]
    x = np.vstack([c for c, _ in chains]).astype(float)
    scale = x.std(0) + 1e-3
    x /= scale
    starts = np.cumsum([0, *(len(c) for c, _ in chains)])
    y = np.repeat([label for _, label in chains], np.diff(starts)).astype(float)
    seen = np.zeros((2, 2))
    for c, label in chains:
        seen[label, label] += len(c) - 1
    w = np.zeros(WIDTH + 4)
    m, v = np.zeros_like(w), np.zeros_like(w)
    for i in range(1, rounds + 1):
        p, pairs, _ = marginals(x @ w[:WIDTH], w[WIDTH:].reshape(2, 2), starts)
        g = np.concatenate([x.T @ (y - p), (seen - pairs).ravel()]) / len(x) - ridge * w
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        w += 0.1 * (1 - i / (rounds + 1)) * (m / (1 - 0.9 ** i)) / (np.sqrt(v / (1 - 0.99 ** i)) + 1e-8)
    trans = w[WIDTH:].reshape(2, 2)
    p, _, _ = marginals(x @ w[:WIDTH], trans, starts)
    mean = np.add.reduceat(p * sizes, starts[:-1]) / np.add.reduceat(sizes, starts[:-1])
    return {"emit": w[:WIDTH] / scale, "trans": trans, "odds": calibrate(mean, labels)}


def score_texts(texts: Iterator[str], model: dict) -> Iterator[float]:
    """Length-weighted marginals, some ten thousand lines at a time."""
    def flush(xs, weights):
        starts = np.cumsum([0, *(len(a) for a in weights)])
        p, _, _ = marginals(np.vstack(xs) @ model["emit"], model["trans"], starts)
        w = np.concatenate(weights)
        mean = np.add.reduceat(p * w, starts[:-1]) / np.add.reduceat(w, starts[:-1])
        a, b = model["odds"]
        return (1 / (1 + np.exp(-a - b * log_odds(mean)))).tolist()

    xs, weights, held = [], [], 0
    for text in texts:
        x, n = line_features(text)
        xs.append(x)
        weights.append(n)
        held += len(n)
        if held >= BLOCK_LINES:
            yield from flush(xs, weights)
            xs, weights, held = [], [], 0
    if xs:
        yield from flush(xs, weights)


def training_run(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Features and lengths of at most ``TRAIN_LINES`` neighbouring lines."""
    x, n = line_features(text)
    start = zlib.crc32(text.encode("utf-8", "replace")) % max(1, len(x) - TRAIN_LINES + 1)
    return x[start:start + TRAIN_LINES], n[start:start + TRAIN_LINES]


def train(docs: DataFrame, labels: DataFrame, limit: int = TRAIN_DOCS) -> dict | None:
    """Fit on the ``limit`` labelled documents outside fold 0 with the smallest id hashes."""
    chosen = (labels.select("doc_id", F.col("quality").alias("y")).where("doc_id IS NOT NULL AND y IN (0, 1)")
              .where(fold(F.col("doc_id"), FOLDS) != 0)
              .groupBy("doc_id").agg(F.min("y").alias("y"))
              .orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit))
    rows = one_text_each(id_and_text(docs).join(F.broadcast(chosen), "doc_id").select("doc_id", "y", "text"))

    def features(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            some = list(map(training_run, b.text))
            yield pd.DataFrame({"doc_id": b.doc_id, "y": b.y, "n": [n for _, n in some], "x": [x.ravel() for x, _ in some]})

    got = rows.mapInPandas(features, "doc_id long, y int, n array<double>, x array<float>").toPandas().sort_values("doc_id")
    if got.y.nunique() < 2:
        return None
    return fit([(np.asarray(r.x).reshape(-1, WIDTH), np.asarray(r.n), int(r.y)) for r in got.itertuples()])


def line_crf_quality(docs: DataFrame, labels: DataFrame, train_docs: int = TRAIN_DOCS) -> DataFrame:
    """doc_id, held_out, score and predicted (1 where score reaches ``THRESHOLD``) per document."""
    model = train(docs, labels, train_docs)

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series(list(score_texts(iter(texts), model)), dtype=float)

    d = id_and_text(docs)
    d = d.select("doc_id", (fold(F.col("doc_id"), FOLDS) == 0).alias("held_out"),
                 (score("text") if model else F.lit(0.5)).alias("score"))
    return d.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
