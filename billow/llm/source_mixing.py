"""Mixing documents to target domain weights.

*Soft membership.*  Domains are the value pairs (quality, toxic) of a labelled
table.  A classifier (softmax over log word counts in a hashed vocabulary and a
few shares of characters) learns them from at most ``TRAIN_DOCS`` labelled
documents, chosen evenly by a hash of their id, and gives every document a
posterior over domains.

*Rates.*  Projected gradient descent finds rates r >= 0 (and at most ``max_rate``,
if given) that minimise the squared error between the expected domain totals,
sum of r * tokens * posterior, and the targets, weighted by the inverse Gram
matrix of the posteriors.  Documents are variables in the metric of their tokens,
so a step moves r by the posterior times the weighted residuals.  Each step is one distributed sum of as many numbers as there are
domains; a document's rate follows from its posterior and the steps so far, so
steps are replayed where they are needed and no state is kept.  Documents are
grouped into cells by posterior, rounded to ``GRID`` parts, before the descent: its
table is bounded by the number of grid points, whatever the corpus.  A cell has one
rate and the exact posterior mass of its documents (sum of tokens * posterior), so
totals, Gram matrix and residuals have no rounding in them.

Defined results: null and empty texts hold no tokens and have the posterior of
an empty text; domains that no labelled training document has do not exist; with
no labelled document, or no tokens, every rate is 1; targets need not sum to 1;
repeated rows have equal rates.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from billow.llm.common import id_and_text, one_text_each, stored

#: Labelled documents to learn from, at most (the sample's documented bound).
TRAIN_DOCS = 3000
BUCKETS = 4096
SHARES = (b"#*$%&|<>", bytes(range(65, 91)), bytes(range(48, 58)), b".,;:", b"!?", b" \t\n\x0b\x0c\r")
WIDTH = BUCKETS + len(SHARES) + 2
GRID = 64
#: The descent ends where no domain misses its target by more than TARGET_ERROR of all tokens, or, for targets that no
#: rates can meet, where a step moves rates by less than MOVED (root mean square over tokens).  ROUNDS only guards
#: against a descent that does neither: then an error tells so.
TARGET_ERROR = 1e-5
MOVED = 3e-5
ROUNDS = 5000
#: Cells that one task of a step sums.
CELLS_A_TASK = 20_000
MEMO_WORDS = 300_000
_memo: dict[bytes, int] = {}


def word_buckets(words: list[bytes]) -> np.ndarray:
    if len(_memo) > MEMO_WORDS:
        _memo.clear()
    for w in set(words).difference(_memo):
        _memo[w] = xxhash.xxh32_intdigest(w.lower()) % BUCKETS
    return np.fromiter(map(_memo.__getitem__, words), np.int64, len(words))


def parts_of(text: str) -> tuple[np.ndarray, np.ndarray, int]:
    """(hashed words that occur, dense shares, number of words); a word counts once, whatever its repeats."""
    raw = text.encode("utf-8", "replace")
    words = raw.split()
    kinds = list(set(words))
    dense = np.array([(len(raw) - len(raw.translate(None, s))) / (len(raw) + 1) for s in SHARES] + [len(kinds) / (len(words) + 1), 1.0])
    return np.unique(word_buckets(kinds)), dense, len(words)


class Classifier:
    """Softmax of summed word weights over the square root of their number, plus dense weights."""

    def __init__(self, classes: list, words: np.ndarray, dense: np.ndarray) -> None:
        self.classes, self.words, self.dense = classes, words, dense

    def posterior(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        out, sizes = np.empty((len(texts), len(self.classes))), np.empty(len(texts), np.int64)
        for i, text in enumerate(texts):
            at, dense, sizes[i] = parts_of(text)
            out[i] = self.words[at].sum(0) / np.sqrt(len(at) + 1) + dense @ self.dense
        e = np.exp(out - out.max(1, keepdims=True))
        return e / e.sum(1, keepdims=True), sizes

    @classmethod
    def fit(cls, rows: list[tuple[np.ndarray, np.ndarray, tuple]], rounds: int = 150, ridge: float = 1e-4) -> Classifier:
        classes = sorted({c for _, _, c in rows})
        y = np.array([classes.index(c) for _, _, c in rows])
        lens = np.array([len(a) for a, _, _ in rows])
        word, row = np.concatenate([a for a, _, _ in rows]), np.repeat(np.arange(len(rows)), lens)
        value = 1 / np.sqrt(lens + 1)
        dense, one = np.array([d for _, d, _ in rows]), np.eye(len(classes))[y]
        k = len(classes)
        w, m, v = np.zeros((WIDTH, k)), np.zeros((WIDTH, k)), np.zeros((WIDTH, k))
        for i in range(1, rounds + 1):
            z = np.stack([np.bincount(row, w[word, c], len(rows)) for c in range(k)], 1) * value[:, None] + dense @ w[BUCKETS:]
            p = np.exp(z - z.max(1, keepdims=True))
            g = (p / p.sum(1, keepdims=True) - one) / len(rows)
            grad = np.vstack([np.stack([np.bincount(word, (g[:, c] * value)[row], BUCKETS) for c in range(k)], 1), dense.T @ g]) + ridge * w
            m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad * grad
            w -= 0.1 * (1 - i / (rounds + 1)) * (m / (1 - 0.9 ** i)) / (np.sqrt(v / (1 - 0.99 ** i)) + 1e-8)
        return cls(classes, w[:BUCKETS], w[BUCKETS:])


def train(docs: DataFrame, labels: DataFrame, limit: int = TRAIN_DOCS) -> Classifier | None:
    chosen = (labels.where("doc_id IS NOT NULL AND quality IS NOT NULL AND toxic IS NOT NULL")
              .groupBy("doc_id").agg(F.min(F.struct("quality", "toxic")).alias("domain"))
              .orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit).select("doc_id", "domain.quality", "domain.toxic"))
    rows = one_text_each(id_and_text(docs).join(F.broadcast(chosen), "doc_id").select("doc_id", "quality", "toxic", "text"))

    def features(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            made = [parts_of(t) for t in b.text]
            yield pd.DataFrame({"doc_id": b.doc_id, "quality": b.quality, "toxic": b.toxic, "at": [a for a, _, _ in made], "dense": [d for _, d, _ in made]})

    got = rows.select("doc_id", "quality", "toxic", "text").mapInPandas(features, "doc_id long, quality int, toxic int, at array<long>, dense array<double>").toPandas()
    got = got.sort_values("doc_id")
    if got.empty:
        return None
    return Classifier.fit([(np.asarray(r.at, np.int64), np.asarray(r.dense), (r.quality, r.toxic)) for r in got.itertuples()])


def domain_name(domain: tuple) -> str:
    return f"quality{domain[0]}_toxic{domain[1]}"


def soft_members(docs: DataFrame, model: Classifier) -> DataFrame:
    """doc_id, text_key, tokens, posterior (array of doubles), cell (posterior in ``GRID`` parts) per document."""

    def member(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            p, tokens = model.posterior(list(b.text))
            cell = np.floor(p * GRID + 0.5).astype(np.int64)
            yield pd.DataFrame({"doc_id": b.doc_id.astype("Int64"), "text_key": b.text_key, "tokens": tokens, "posterior": list(p), "cell": list(cell)})

    rows = id_and_text(docs).withColumn("text_key", F.xxhash64("text"))
    return rows.mapInPandas(member, "doc_id long, text_key long, tokens long, posterior array<double>, cell array<long>")


def replay(p: np.ndarray, steps: list[tuple[np.ndarray, bool]], max_rate: float | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Posteriors p (rows) after the projected gradient steps (FISTA, from 1): the point where the next step
    is taken, what the last step moved, and what momentum moved against it (its sign says whether momentum still helps).
    A step is a gradient by domain and whether momentum starts anew."""
    top = np.inf if max_rate is None else max_rate
    r = np.minimum(np.ones(len(p)), top)
    ahead, t, moved, against = r, 1.0, np.zeros(len(p)), np.zeros(len(p))
    for g, anew in steps:
        new = np.clip(ahead - p @ g, 0, top)
        t = 1.0 if anew else t
        t_new = (1 + np.sqrt(1 + 4 * t * t)) / 2
        moved, against = new - ahead, (ahead - new) * (new - r)
        ahead, r, t = new + (t - 1) / t_new * (new - r), new, t_new
    return ahead, moved, against


def cell_table(members: DataFrame, k: int) -> DataFrame:
    """cell, tokens and mean (posterior by tokens; plain where a cell has none) of each cell.  Sums are decimals, so
    that they don't depend on the order of rows."""
    p = [F.col("posterior")[i] for i in range(k)]
    exact = lambda c: F.sum(c.cast("decimal(28,12)")).cast("double")
    got = members.groupBy("cell").agg(F.sum("tokens").alias("tokens"), F.count("*").alias("n"),
                                      *[exact(F.col("tokens") * x).alias(f"m{i}") for i, x in enumerate(p)], *[exact(x).alias(f"p{i}") for i, x in enumerate(p)])
    mean = F.array(*[F.when(F.col("tokens") > 0, F.col(f"m{i}") / F.col("tokens")).otherwise(F.col(f"p{i}") / F.col("n")) for i in range(k)])
    return got.select("cell", "tokens", mean.alias("mean"))


def sums(cells: DataFrame, k: int, value) -> np.ndarray:
    """Sum over all cells of value(mean posteriors, tokens), a vector of k numbers; a few rows per task come back."""
    mean = "mean" if "mean" in cells.columns else "cell"

    def add(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            p = np.array(b[mean].tolist(), float).reshape(len(b), -1)
            yield pd.DataFrame({"k": np.arange(k), "s": value(p / p.sum(1, keepdims=True), b.tokens.to_numpy(float))})

    got = cells.mapInPandas(add, "k int, s double").toPandas()
    return np.bincount(got.k, got.s, k)


def descend(cells: DataFrame, target: np.ndarray, total: float, max_rate: float | None, rounds: int = ROUNDS) -> list[tuple[np.ndarray, bool]]:
    """Steps of the descent on (cell, tokens, mean); each is one distributed sum over cells (no mean: the cell itself)."""
    k, steps = len(target), []
    gram = sums(cells, k * k, lambda p, n: (p.T @ (p * n[:, None])).ravel()).reshape(k, k) / total
    weight = np.linalg.inv(gram + 1e-4 * np.eye(k))  # no curvature over 1 is left, whatever rates are held at a bound

    def of_cells(p: np.ndarray, n: np.ndarray) -> np.ndarray:
        rate, moved, against = replay(p, steps, max_rate)
        return np.r_[(p * (rate * n)[:, None]).sum(0), (n * moved * moved).sum(), (n * against).sum()]

    for _ in range(rounds):
        *got, moved, against = sums(cells, k + 2, of_cells)
        residual = (np.array(got) - target) / total
        if np.abs(residual).max() < TARGET_ERROR or steps and np.sqrt(moved / total) < MOVED:
            return steps
        steps.append((weight @ residual, against > 0))
    raise RuntimeError(f"the descent did not settle in {rounds} rounds; residual by domain {residual}")


def final_rates(p: np.ndarray, steps: list[tuple[np.ndarray, bool]], max_rate: float | None) -> np.ndarray:
    return np.clip(replay(p, steps, max_rate)[0], 0, np.inf if max_rate is None else max_rate)


def mixing_rates(docs: DataFrame, labels: DataFrame, weights: dict[tuple, float], budget: float = 1.0,
                 max_rate: float | None = None, train_docs: int = TRAIN_DOCS) -> DataFrame:
    """doc_id, text_key, tokens, posterior by domain name, domain (likeliest) and rate of every document.

    weights: target share of tokens of each (quality, toxic); domains without one get 0.  budget: expected
    tokens of the mixture as a multiple of the corpus's tokens."""
    model = train(docs, labels, train_docs)
    if model is None:
        return id_and_text(docs).select("doc_id", F.xxhash64("text").alias("text_key"), F.lit(0).cast("long").alias("tokens"),
                                        F.expr("CAST(map() AS map<string,double>)").alias("posterior"), F.lit(None).cast("string").alias("domain"), F.lit(1.0).alias("rate"))
    members = stored(soft_members(docs, model), "mix_members")
    every = stored(cell_table(members, len(model.classes)), "mix_cells")
    cells = every.where("tokens > 0")
    total = float(cells.agg(F.sum("tokens")).first()[0] or 0)
    share = np.array([weights.get(c, 0.0) for c in model.classes])
    steps = descend(cells.coalesce(-(-cells.count() // CELLS_A_TASK)), share / max(share.sum(), 1e-12) * budget * total, total, max_rate) if total and share.sum() else []

    @F.pandas_udf("double")
    def rate(mean: pd.Series) -> pd.Series:
        p = np.array(mean.tolist(), float).reshape(len(mean), len(model.classes))
        return pd.Series(final_rates(p / p.sum(1, keepdims=True), steps, max_rate))

    names = F.array(*[F.lit(domain_name(c)) for c in model.classes])
    rates = every.select("cell", rate("mean").alias("rate"))
    out = members.withColumn("key", F.xxhash64("cell")).join(rates.select(F.xxhash64("cell").alias("key"), F.col("cell").alias("c"), "rate"), "key").where("cell = c")
    return out.select("doc_id", "text_key", "tokens", F.map_from_arrays(names, "posterior").alias("posterior"),
                      F.element_at(names, F.array_position("posterior", F.array_max("posterior")).cast("int")).alias("domain"), "rate")


def copies(rate: Column, doc_id: Column, text_key: Column, seed: int = 0) -> Column:
    """Whole copies of a document with this rate: its whole part, and one more with the rest as probability,
    drawn from the document's id and text."""
    draw = F.pmod(F.xxhash64(F.lit(seed), doc_id, text_key), F.lit(1 << 30)) / float(1 << 30)
    return (F.floor(rate) + (draw < rate - F.floor(rate)).cast("int")).cast("int")
