"""Quality rules: fixed base limits, then robust multivariate outliers.

Base statistics are counted per document with SQL functions only.  The method
then looks at a vector of transformed statistics (word length, share of symbols,
of capitals, of repeated lines and of repeated words).  For each language and
source it fits a minimum-covariance-determinant estimate: concentration steps
keep the ``H_SHARE`` of rows that lie nearest to the current centre and fit
centre and covariance to them again.  A document whose squared Mahalanobis
distance passes ``CUTOFF`` is rejected.

The fits read all rows that pass the base limits.  A group's distance quantile
comes from exact counts per logarithmic distance bin, so no group is ever held
in one task.  Estimates shrink: to a group's sums are added ``PRIOR_ROWS`` rows
with the mean moments of its language, and to the language's as many with those of
the corpus.  So every group of any size has its own estimate, a row alone is judged
by its language, and a document's verdict moves smoothly as its group grows.

Defined results: null text has no words (and so fails the base limits); null
language or source is a group of its own; repeated rows are judged each on
their own; an empty table gives an empty result.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from billow.llm.common import BROADCAST_ROWS, WS, stored

MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
WINDOW = 5
SYMBOLS = "#*$%&|<>"
#: Documents with this few words lean on a prior of this many typical ones.
PRIOR_WORDS = 50
H_SHARE = 0.75
STEPS = 4
#: Rows of its language (and, for a language, of the corpus) that each estimate leans on.
PRIOR_ROWS = 200
#: Bins per doubling of the squared distance when its quantile is sought.
BINS = 32
#: A document is rejected whose squared distance lies beyond this chi-square quantile.
CUT_SHARE = 0.999
#: Smallest standard deviation taken for each transformed statistic, in order of FEATURES.
FEATURES = {"f_len": 0.05, "f_symbols": 0.04, "f_upper": 0.03, "f_lines": 0.05, "f_repeat": 0.05}
P = len(FEATURES)


def repeated_words(words: str) -> dict[str, Column]:
    """Columns, one step each, that end in n_repeat_words: words inside ``WINDOW``-word windows seen
    twice or more.  64-bit window hashes tell the many documents without any repeat apart; the others
    compare whole windows.  The windows that repeat, in text order, each add the words that the one
    before has not covered."""
    w = WINDOW - 1
    at = ", ".join(f"{words}[i + {k}]" for k in range(WINDOW))
    return {
        "w_hash": F.expr(f"IF(size({words}) > {w}, transform(sequence(0, size({words}) - {WINDOW}), i -> xxhash64({at})), array())"),
        "w_sorted": F.expr(f"""IF(size(array_distinct(w_hash)) < size(w_hash),
            array_sort(transform(sequence(0, size({words}) - {WINDOW}), i -> struct(concat_ws(' ', slice({words}, i + 1, {WINDOW})) AS g, i AS p))),
            NULL)"""),
        "w_repeat": F.expr("""IF(w_sorted IS NULL, NULL, array_sort(filter(transform(sequence(0, size(w_sorted) - 1),
            k -> IF((k > 0 AND w_sorted[greatest(k - 1, 0)].g = w_sorted[k].g)
                 OR (k < size(w_sorted) - 1 AND w_sorted[least(k + 1, size(w_sorted) - 1)].g = w_sorted[k].g), w_sorted[k].p, -1)), p -> p >= 0)))"""),
        "n_repeat_words": F.expr(f"""CAST(IF(w_repeat IS NULL, 0, aggregate(w_repeat, struct(0L AS n, -{WINDOW} AS last),
            (a, p) -> struct(a.n + least({WINDOW}, p - a.last) AS n, p AS last), a -> a.n)) AS BIGINT)"""),
    }


def base_statistics(docs: DataFrame) -> DataFrame:
    """doc_id, lang, source, the contract's counts, line count and capitals of every whole text."""
    d = docs.select("doc_id", "lang", "source", F.coalesce("text", F.lit("")).alias("text"))
    d = d.withColumn("text_key", F.xxhash64("text"))
    d = d.withColumns({"words": F.filter(F.split("text", WS), lambda w: w != ""),
                       "lines": F.filter(F.split("text", "\n"), lambda x: F.length(F.translate(x, " \t\x0b\x0c\r", "")) > 0)})
    d = d.select("doc_id", "text_key", "lang", "source", "words", F.size("words").cast("long").alias("n_words"),
                 F.length(F.regexp_replace("text", WS, "")).cast("long").alias("word_chars"),
                 F.length(F.regexp_replace("text", f"[^{SYMBOLS}]+", "")).cast("long").alias("n_symbols"),
                 F.length(F.regexp_replace("text", r"\P{Lu}+", "")).cast("long").alias("n_upper"),
                 F.size("lines").cast("long").alias("n_lines"),
                 (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"))
    for name, step in repeated_words("words").items():
        d = d.withColumn(name, step)
    d = d.drop("words", "w_hash", "w_sorted", "w_repeat")
    return d.withColumn("base_failed", (F.col("n_words") < MIN_WORDS)
                        | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")))


def features(d: DataFrame) -> DataFrame:
    n = F.col("n_words") + PRIOR_WORDS
    return d.withColumns({
        "f_len": F.log((F.col("word_chars") + 5.0 * PRIOR_WORDS) / n),
        "f_symbols": F.sqrt(F.col("n_symbols") / (F.col("word_chars") + 5.0 * PRIOR_WORDS)),
        "f_upper": F.sqrt(F.col("n_upper") / (F.col("word_chars") + 5.0 * PRIOR_WORDS)),
        "f_lines": F.col("n_dup_lines") / (F.col("n_lines") + 10.0),
        "f_repeat": F.col("n_repeat_words") / n,
    })


def chi2_cdf_odd(x: float, k: int) -> float:
    """Chi-square distribution function for odd degrees of freedom."""
    term, total = math.sqrt(2 * x / math.pi) * math.exp(-x / 2), 0.0
    for j in range(1, k, 2):
        total, term = total + term, term * x / (j + 2)
    return math.erf(math.sqrt(x / 2)) - total


def chi2_quantile_odd(share: float, k: int) -> float:
    """Chi-square quantile for odd degrees of freedom."""
    lo, hi = 0.0, 100.0
    for _ in range(80):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if chi2_cdf_odd(mid, k) < share else (lo, mid)
    return lo


#: Squared distance beyond which a document is rejected: 20.5 for five statistics.
CUTOFF = chi2_quantile_odd(CUT_SHARE, P)


def consistency() -> float:
    """Factor that makes the covariance of the nearest ``H_SHARE`` of normal rows a normal covariance."""
    return H_SHARE / chi2_cdf_odd(chi2_quantile_odd(H_SHARE, P), P + 2)


def covariance(i: int, j: int) -> str:
    """SQL of one covariance entry from a group's sums; the diagonal has the floor added."""
    floor = f" + {list(FEATURES.values())[i] ** 2!r}" if i == j else ""
    return f"({consistency()!r} * (s{min(i, j)}{max(i, j)} / s - (s{i} / s) * (s{j} / s)){floor})"


MOMENTS = ["s", *[f"s{i}" for i in range(P)], *[f"s{i}{j}" for i in range(P) for j in range(i, P)]]


def shrunk(sums: DataFrame, prior: int) -> DataFrame:
    """The groups' sums, with ``prior`` rows of their language's mean moments, which lean on the corpus's."""
    by_lang = sums.groupBy("lng").agg(*[F.sum(m).alias(f"l_{m}") for m in MOMENTS])
    corpus = by_lang.agg(*[F.sum(f"l_{m}").alias(f"c_{m}") for m in MOMENTS])
    # one row: the whole corpus
    langs = by_lang.withColumn("all", F.lit(0)).join(F.broadcast(corpus.withColumn("all", F.lit(0))), "all")
    langs = langs.select("lng", *[F.expr(f"(l_{m} + {prior} * c_{m} / c_s) / (l_s + {prior})").alias(f"p_{m}") for m in MOMENTS])
    return sums.join(langs, "lng").select("grp", "lng", *[F.expr(f"{m} + {prior} * p_{m}").alias(m) for m in MOMENTS])


def with_distance(rows: DataFrame, sums: DataFrame, sized) -> DataFrame:
    """Squared Mahalanobis distance d2 by Cholesky factors, written out as columns of the group's row.

    The group table is one row per language and source; ``sized`` marks it for broadcast where it is small."""
    fit = sums
    for i in range(P):
        for j in range(i + 1):
            less = "".join(f" - l{i}{k} * l{j}{k}" for k in range(j))
            entry = f"{covariance(i, j)}{less}"
            fit = fit.withColumn(f"l{i}{j}", F.expr(f"sqrt(greatest({entry}, 1e-12))" if i == j else f"({entry}) / l{j}{j}"))
    fit = fit.select("grp", *[F.expr(f"s{i} / s").alias(f"m{i}") for i in range(P)],
                     *[f"l{i}{j}" for i in range(P) for j in range(i + 1)])
    out = rows.join(sized(fit), "grp", "left")
    for i, name in enumerate(FEATURES):
        less = "".join(f" - l{i}{k} * z{k}" for k in range(i))
        out = out.withColumn(f"z{i}", F.expr(f"({name} - m{i}{less}) / l{i}{i}"))
    return out.withColumn("d2", F.expr(" + ".join(f"z{i} * z{i}" for i in range(P)))).select(*rows.columns, "d2")


def sums_of(rows: DataFrame) -> DataFrame:
    f = list(FEATURES)
    return rows.groupBy("grp", "lng", "bin").agg(
        F.count("*").cast("double").alias("s"), *[F.sum(f[i]).alias(f"s{i}") for i in range(P)],
        *[F.sum(F.col(f[i]) * F.col(f[j])).alias(f"s{i}{j}") for i in range(P) for j in range(i, P)])


def nearest(rows: DataFrame, distance: str) -> DataFrame:
    """Sums over the rows of each group up to the bin in which the ``H_SHARE`` quantile of ``distance`` lies.

    Rows are read once, summed by group and bin; the rest works on those sums, some thousand bins a group at most."""
    bins = sums_of(rows.withColumn("bin", F.expr(f"CAST(floor(log2(greatest({distance}, 1e-9)) * {BINS}) AS INT)")))
    group = Window.partitionBy("grp")
    before = F.coalesce(F.sum("s").over(group.orderBy("bin").rangeBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    near = bins.withColumns({"before": before, "n": F.sum("s").over(group)}).where(f"before < n * {H_SHARE}")
    return near.groupBy("grp", "lng").agg(*[F.sum(m).alias(m) for m in MOMENTS])


def start(rows: DataFrame, sized) -> DataFrame:
    """First distances: from the group's medians (by the floors' scale), which outliers barely move."""
    med = rows.groupBy("grp").agg(*[F.percentile_approx(f, 0.5, 1000).alias(f"c_{f}") for f in FEATURES])
    d0 = " + ".join(f"pow(({f} - c_{f}) / {s!r}, 2)" for f, s in FEATURES.items())
    return rows.join(sized(med), "grp").withColumn("d2", F.expr(d0)).select(*rows.columns, "d2")


def quality_rules(docs: DataFrame, prior: int = PRIOR_ROWS) -> DataFrame:
    """doc_id, the base counts, base_failed, kept, the squared distance that decided (null: no row of its
    language and source passed the base limits), and the 64-bit hash of the text."""
    null_or = lambda c: F.concat(F.col(c).isNull().cast("string"), F.coalesce(c, F.lit("")))
    named = features(base_statistics(docs)).withColumns({"lng": null_or("lang"), "grp": F.concat_ws("|", null_or("lang"), null_or("source"))})
    rows = stored(named.select("grp", "lng", "doc_id", "text_key", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                               "base_failed", *FEATURES), "rules_rows")
    fitted = rows.where("NOT base_failed").select("grp", "lng", *FEATURES)
    # tables of one row a group are broadcast up to a bound on groups, and join by shuffle beyond
    sized = F.broadcast if fitted.select("grp").distinct().count() <= BROADCAST_ROWS else lambda df: df
    # sums are stored as they are: shrinking reads them three times, and is worked out where it is used
    sums = stored(nearest(start(fitted, sized), "d2"), "rules_sums")
    for _ in range(STEPS):
        sums = stored(nearest(with_distance(fitted, shrunk(sums, prior), sized), "d2"), "rules_sums")
    judged = with_distance(rows, shrunk(sums, prior), sized)
    outlier = F.coalesce(F.col("d2") > CUTOFF, F.lit(False))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
                         (~F.col("base_failed") & ~outlier).alias("kept"), F.col("d2").alias("distance"), "text_key")
