"""Spelling variants: words one edit apart, found with bidirectional FM-indexes.

Words are the maximal runs of letters of all texts, A-Z folded; a run whose
crc32 with its document's id is divisible by ``TYPO`` loses one letter.  The
vocabulary holds what is long (``MIN_LENGTH``) and frequent (``MIN_COUNT``) enough.

*Search scheme.*  A pattern within one edit of a word matches one half of it
exactly.  A block of the vocabulary, each word between delimiters, is indexed
twice: as it stands and mirrored.  A query matches one half exactly up to its
delimiter, while the suffix-rank interval of the mirrored text is kept in step,
and is then extended across the other half in that text, allowing one inserted,
deleted or replaced letter.  An interval that ends in the second delimiter is one word.

*Routing.*  Words meet where they share a half: a word is indexed under each
prefix and suffix that is a half of some word of its own length, one more or one
less, and asks under its own two halves.  Halves are dealt to buckets by hash; a
bucket with more than ``BLOCK`` words is cut into index blocks and query blocks
that all meet each other, so no task holds more than one block of each.  A pair found by
its suffix only counts where the word does not begin with the query's first half,
so each pair counts once.  Blocks return one row for a query (how many, the most frequent), never pairs.

Defined results: null texts have no words; a null id counts as empty text in the
crc32; repeated rows count again; an empty table or vocabulary gives an empty
result; only doc_id and text are read, so other columns cannot clash.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from billow.llm.common import small, stored

RUN = r"[A-Za-zÀ-ÿ]"
TYPO = 31
MIN_LENGTH, MIN_COUNT = 7, 2
#: A form is at least so many times as frequent.
RATIO = 10
#: Words indexed together, and queries put to them together.
BLOCK = 30_000
#: Queries that are searched at a time (bounds memory: so many rows by alphabet).
CHUNK = 8192


def word_counts(docs: DataFrame, typo: int = TYPO, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT) -> DataFrame:
    """word, n of the vocabulary."""
    folded = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    # a shorter run cannot become a word of min_length; a greedy run of at least so many letters is a maximal one
    runs = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"),
                       F.explode(F.regexp_extract_all(folded, F.lit(f"{RUN}{{{min_length},}}"), F.lit(0))).alias("run"))
    runs = runs.withColumn("h", F.crc32(F.concat("id", F.lit(":"), "run").cast("binary")))
    cut = F.expr("concat(substring(run, 1, CAST(h % length(run) AS INT)), substring(run, CAST(h % length(run) AS INT) + 2))")
    words = runs.select(F.when(F.col("h") % typo == 0, cut).otherwise(F.col("run")).alias("word"))
    return words.groupBy("word").agg(F.count("*").alias("n")).where((F.length("word") >= min_length) & (F.col("n") >= min_count))


class Ranks:
    """Suffix ranks of ``words`` (code arrays), each after a delimiter 0: one direction of the index.

    ``step(c, i)`` is the rank of what begins with c among ranks below i; the rows of the
    delimiter are the words in sorted order, ``word_of`` gives their numbers."""

    def __init__(self, words: list[str], letters: np.ndarray) -> None:
        self.sigma, order = len(letters) + 1, sorted(range(len(words)), key=words.__getitem__)
        self.word_of = np.array(order)
        text = "\0" + "\0".join(words[i] for i in order)
        points = np.frombuffer(text.encode("utf-32-le"), np.uint32)
        symbols = np.searchsorted(letters, points, "right").astype(np.int64)
        self.n = len(symbols)
        before = symbols[self._suffixes(symbols) - 1]
        blocks = self.n // 64 + 1
        padded = np.full(blocks * 64, -1)
        padded[: self.n] = before
        self.starts = np.searchsorted(np.sort(symbols), np.arange(self.sigma))
        self.bits, self.sums = np.empty((2, blocks, self.sigma), np.uint64), np.empty((2, blocks, self.sigma), np.int64)
        for c in range(self.sigma):
            for k, hit in enumerate((padded == c, (padded >= 0) & (padded < c))):
                self.bits[k, :, c] = np.packbits(hit, bitorder="little").view(np.uint64)
                counts = np.bitwise_count(self.bits[k, :, c]).astype(np.int64)
                self.sums[k, :, c] = np.cumsum(counts) - counts
        self.sums[0] += self.starts

    def _suffixes(self, symbols: np.ndarray) -> np.ndarray:
        """Positions of all rotations in sorted order, by doubling; words differ, so rotations do."""
        width = max(1, int(self.sigma - 1).bit_length())
        known = 62 // width
        key = np.zeros(self.n, np.int64)
        for i in range(known):
            key = (key << width) | np.roll(symbols, -(i % self.n))
        while True:
            order = np.argsort(key, kind="stable")
            ordered = key[order]
            rank = np.empty(self.n, np.int64)
            rank[order] = np.cumsum(np.r_[0, ordered[1:] != ordered[:-1]])
            if rank[order[-1]] == self.n - 1:
                return order
            key = rank * self.n + np.roll(rank, -(known % self.n))
            known *= 2

    def _count(self, k: int, c: np.ndarray, i: np.ndarray) -> np.ndarray:
        at, low = i >> 6, (np.uint64(1) << (i & 63).astype(np.uint64)) - np.uint64(1)
        return self.sums[k, at, c] + np.bitwise_count(self.bits[k, at, c] & low)

    def step(self, c: np.ndarray, i: np.ndarray) -> np.ndarray:
        return self._count(0, c, i)

    def smaller(self, c: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        """Symbols below c before the ranks lo to hi."""
        return self._count(1, c, hi) - self._count(1, c, lo)

    def step_all(self, i: np.ndarray) -> np.ndarray:
        """step of every symbol: a row for each i."""
        at, low = i >> 6, (np.uint64(1) << (i & 63).astype(np.uint64)) - np.uint64(1)
        return self.sums[0, at] + np.bitwise_count(self.bits[0, at] & low[:, None])


class Index:
    """Both directions over one block of distinct words."""

    def __init__(self, words: list[str]) -> None:
        self.words = words
        self.letters = np.unique(np.frombuffer("".join(words).encode("utf-32-le"), np.uint32))
        self.forward, self.mirrored = Ranks(words, self.letters), Ranks([w[::-1] for w in words], self.letters)

    def codes(self, queries: list[str]) -> np.ndarray:
        """Symbols of queries of one length, -1 for letters that no word has."""
        points = np.frombuffer("".join(queries).encode("utf-32-le"), np.uint32).reshape(len(queries), -1)
        at = np.searchsorted(self.letters, points)
        return np.where(self.letters[np.minimum(at, len(self.letters) - 1)] == points, at + 1, -1)

    def near(self, queries: list[str], by_suffix: bool = False) -> tuple[np.ndarray, np.ndarray]:
        """(query number, word number) of all words one edit from queries of one length that share their first half
        (by_suffix: their second half, but not their first)."""
        half, codes = len(queries[0]) // 2, self.codes(queries)
        if not by_suffix:
            return self._pairs(self.forward, self.mirrored, codes, half)
        q, w = self._pairs(self.mirrored, self.forward, codes[:, ::-1], codes.shape[1] - half)
        other = np.array([not self.words[j].startswith(queries[i][:half]) for i, j in zip(q.tolist(), w.tolist())], bool)
        return q[other], w[other]

    def _pairs(self, here: Ranks, there: Ranks, codes: np.ndarray, half: int) -> tuple[np.ndarray, np.ndarray]:
        at = np.flatnonzero((codes[:, :half] > 0).all(1))
        lo, hi, other = np.zeros(len(at), np.int64), np.full(len(at), here.n), np.zeros(len(at), np.int64)
        for j in range(half - 1, -2, -1):  # the exact half, from its inner end to its delimiter
            c = codes[at, j] if j >= 0 else np.zeros(len(at), np.int64)
            other = other + here.smaller(c, lo, hi)
            lo, hi = here.step(c, lo), here.step(c, hi)
            live = lo < hi
            at, lo, hi, other = at[live], lo[live], hi[live], other[live]
        hi, lo = other + hi - lo, other  # the same occurrences, in the mirrored text
        one = (np.zeros(0, np.int64),) * 3  # query, interval of states with one edit
        for j in range(half, codes.shape[1] + 1):
            lows, highs = there.step_all(lo), there.step_all(hi)
            live = lows < highs
            live[:, 0] = False  # no edit makes a delimiter
            row, c = np.nonzero(live)
            one = [np.concatenate(x) for x in zip(one, (at[row], lows[row, c], highs[row, c]))]  # inserted
            if j == codes.shape[1]:
                break
            one = self._advance(there, codes[one[0], j], *one)
            changed = c != codes[at[row], j]
            row, c = row[changed], c[changed]
            one = [np.concatenate(x) for x in zip(one, (at[row], lows[row, c], highs[row, c]), (at, lo, hi))]  # replaced, deleted
            at, lo, hi = self._advance(there, codes[at, j], at, lo, hi)
        query, row, _ = self._advance(there, np.zeros(len(one[0]), np.int64), *one)
        pairs = np.unique(query * len(self.words) + there.word_of[row])
        return pairs // len(self.words), pairs % len(self.words)

    @staticmethod
    def _advance(ranks: Ranks, c: np.ndarray, at: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, ...]:
        known = c >= 0
        c, at, lo, hi = c[known], at[known], lo[known], hi[known]
        lo, hi = ranks.step(c, lo), ranks.step(c, hi)
        live = lo < hi
        return at[live], lo[live], hi[live]


RESULT = "word string, n long, near long, best_n long, best string"


def answer(pdf: pd.DataFrame) -> pd.DataFrame:
    """Of one index block and one query block: for each query how many of the words are near, and the most frequent."""
    indexed, asked = pdf[pdf.side < 0].drop_duplicates("word"), pdf[pdf.side >= 0]
    near, best_n = np.zeros(len(asked), np.int64), np.zeros(len(asked), np.int64)
    best = np.full(len(asked), None, object)
    if len(indexed) and len(asked):
        words, counts = indexed.word.tolist(), indexed.n.to_numpy(np.int64)
        index = Index(words)
        order = np.empty(len(words), np.int64)  # place of a word: most frequent first, then by code points
        order[sorted(range(len(words)), key=lambda i: (-counts[i], words[i]))] = np.arange(len(words))
        by_place = np.argsort(order)
        queries, sides = asked.word.to_numpy(object), asked.side.to_numpy()
        lengths = asked.word.str.len().to_numpy()
        for side in (0, 1):
            for length in np.unique(lengths[sides == side]):
                mine = np.flatnonzero((sides == side) & (lengths == length))
                for start in range(0, len(mine), CHUNK):
                    some = mine[start:start + CHUNK]
                    q, w = index.near(queries[some].tolist(), by_suffix=side == 1)
                    found, first, count = np.unique(q, return_index=True, return_counts=True)
                    if len(found):
                        top = by_place[np.minimum.reduceat(order[w], first)]
                        near[some[found]], best_n[some[found]] = count, counts[top]
                        best[some[found]] = np.array(words, object)[top]
    return pd.DataFrame({"word": asked.word, "n": asked.n, "near": near, "best_n": best_n, "best": best})


def near_words(words: DataFrame, block: int = BLOCK) -> DataFrame:
    """word, n, n_near, best, best_n of a stored table (word, n) of distinct words."""
    spark = words.sparkSession
    total = words.count()
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 8 * total // block + 1)
    size = "length(word)"
    halves = F.expr(f"""array_distinct(flatten(transform(array({size} - 1, {size}, {size} + 1), m -> array(
        named_struct('side', 0, 'half', substring(word, 1, CAST(m div 2 AS INT))), named_struct('side', 1, 'half', right(word, CAST(m - m div 2 AS INT)))))))""")
    own = F.expr(f"""array(named_struct('side', 0, 'half', substring(word, 1, CAST({size} div 2 AS INT))),
        named_struct('side', 1, 'half', right(word, CAST({size} - {size} div 2 AS INT))))""")

    def dealt(keys) -> DataFrame:
        return words.select("word", "n", F.explode(keys).alias("key")).select("word", "n", F.col("key.side").alias("side"),
                                                                             F.expr(f"pmod(xxhash64(key.side, key.half), {buckets})").alias("bucket"))

    indexed, asked = dealt(halves).select("word", "n", "bucket").distinct(), dealt(own)
    sizes = indexed.groupBy("bucket").agg(F.count("*").alias("words")).join(asked.groupBy("bucket").agg(F.count("*").alias("queries")), "bucket", "left")
    sizes = small(stored(sizes.select("bucket", F.ceil(F.col("words") / block).alias("blocks"),
                                      F.ceil(F.coalesce("queries", F.lit(0)) / block).alias("query_blocks")).where("blocks > 1 OR query_blocks > 1"), "spell_sizes"))

    def placed(rows: DataFrame, mine: str, all_of: str) -> DataFrame:
        """A row goes to one of its own kind's blocks and meets all of the other kind's."""
        rows = rows.join(sizes, "bucket", "left").withColumns({c: F.coalesce(c, F.lit(1)) for c in ("blocks", "query_blocks")})
        return rows.withColumn(mine, F.expr(f"pmod(xxhash64(word, 1), {'blocks' if mine == 'block' else 'query_blocks'})")) \
            .withColumn(all_of, F.explode(F.expr(f"sequence(0L, greatest(0L, {'blocks' if all_of == 'block' else 'query_blocks'} - 1L))")))

    cols = ["word", "n", "side", "bucket", "block", "query_block"]
    both = placed(indexed.withColumn("side", F.lit(-1)), "block", "query_block").select(cols).unionByName(placed(asked, "query_block", "block").select(cols))
    found = both.groupBy("bucket", "block", "query_block").applyInPandas(answer, RESULT)
    best = F.min(F.when(F.col("best").isNotNull(), F.struct((-F.col("best_n")).alias("minus"), F.col("best").alias("word"))))
    return found.groupBy("word").agg(F.max("n").alias("n"), F.sum("near").alias("n_near"), best.alias("b")) \
        .select("word", "n", "n_near", F.col("b.word").alias("best"), (-F.col("b.minus")).alias("best_n"))


def roots(links: DataFrame) -> DataFrame:
    """word, root of a stored table (word, form): chains followed to their ends by doubling.

    A form is ``RATIO`` times as frequent as its word, so a chain has at most log10 of the largest count links."""
    now = links.select("word", F.col("form").alias("root"))
    while True:
        further = now.select(F.col("word").alias("__word"), F.col("root").alias("__root"))
        now = stored(now.join(further, F.col("root") == F.col("__word"), "left")
                     .select("word", F.coalesce("__root", "root").alias("root"), F.col("__root").isNotNull().alias("moved")), "spell_roots")
        if now.where("moved").isEmpty():
            return now.select("word", "root")


def spelling_groups(docs: DataFrame, ratio: int = RATIO, typo: int = TYPO, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT, block: int = BLOCK) -> DataFrame:
    """word, form, root, n, n_near, form_n of every word of the vocabulary."""
    words = stored(word_counts(docs, typo, min_length, min_count), "spell_words")
    near = stored(near_words(words, block).withColumns({
        "form": F.when(F.col("best_n") >= ratio * F.col("n"), F.col("best")), "form_n": F.when(F.col("best_n") >= ratio * F.col("n"), F.col("best_n"))}), "spell_near")
    ends = roots(stored(near.where("form IS NOT NULL").select("word", "form"), "spell_links"))
    return near.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
