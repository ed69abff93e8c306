"""Line deduplication across documents, equal lines and lines within a few edits.

Lines (without white space at their ends) of at least ``MIN_WORDS`` words take
part; shorter ones always stay.  A line is removed where the corpus holds an
equal line earlier, in order of document and line number, or where the first place
of its text comes after the first place of a text within ``EDITS`` edits (for
lines of ``NEAR_CHARS`` characters or more).

*Segment-partition join.*  A text is cut into ``EDITS`` + 1 segments; a text within
``EDITS`` edits holds one of them unchanged, shifted by few places.  Each text gives
its own segments (index) and, for every length that can match, the substrings at
the places where a segment may stand (probes).  Keys that index and probe of
different texts share are found by aggregation first, so only their rows are
joined, under a length test and a test of character-pair parity bits (an edit
flips four at most).  Candidates are verified by a banded bit-parallel edit
distance: one machine word per number of edits holds the band of reachable
prefixes.

All steps are DataFrame and SQL functions.  Defined results: null text has no
lines that take part and stays null; a document is known by its doc_id and the
hash of its text together, so repeated rows share a decision; documents come in
order of doc_id, rows with null doc_id last, in order of their text's hash; equal
places of rows with equal doc_id and other texts follow ``TIE`` bits of that hash;
an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from billow.llm.common import discard, small, stored

MIN_WORDS = 5
NEAR_CHARS = 20
EDITS = 2
ENDS = " \t\x0b\x0c\r"
ENOUGH_WORDS = r"(?:[^\x20\x09-\x0D]+[\x20\x09-\x0D]+){%d}[^\x20\x09-\x0D]"
LAST = (1 << 63) - 1
#: Bits of the text's hash that decide between equal line numbers of equal ids (what a decimal has left).
TIE = 30


def text_key() -> Column:
    return F.xxhash64(F.coalesce("text", F.lit("")))


def lines_of(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """doc, text_key, n (line number), line, h1, h2 of every line that takes part."""
    d = docs.select(F.col("doc_id").cast("long").alias("doc"), text_key().alias("text_key"), F.posexplode(F.split("text", "\n")).alias("n", "raw"))
    d = d.select("doc", "text_key", "n", F.expr(f"trim(BOTH '{ENDS}' FROM raw)").alias("line")).where(F.col("line").rlike(ENOUGH_WORDS % (min_words - 1)))
    return d.select("doc", "text_key", "n", "line", F.xxhash64("line").alias("h1"), F.xxhash64(F.lit(1), "line").alias("h2"))


def place() -> Column:
    """Order of (doc, n, ``TIE`` bits of text_key), or for null ids of (text_key, n) after all others, as one number,
    which a hash aggregate can hold.  Known ids are moved to [-2^64, 0), hashes to [0, 2^64)."""
    half, whole = "CAST(9223372036854775808 AS DECIMAL(19, 0))", 1 << (31 + TIE)
    document = f"IF(doc IS NULL, CAST(text_key AS DECIMAL(19, 0)) + {half}, CAST(doc AS DECIMAL(19, 0)) - {half})"
    tie = f"IF(doc IS NULL, 0L, text_key & {(1 << TIE) - 1}L)"
    return F.expr(f"CAST({document} * CAST({whole} AS DECIMAL(19, 0)) AS DECIMAL(38, 0)) + (shiftleft(CAST(n AS BIGINT), {TIE}) | {tie})")


def segment(length: str, i: int, edits: int) -> tuple[str, str]:
    """SQL of (start, length) of segment i of a text of this length; the last ones are one longer."""
    k = edits + 1
    return (f"({i} * ({length} div {k}) + greatest(0, {i} - ({k} - ({length}) % {k})))", f"(({length}) div {k} + IF({i} >= {k} - ({length}) % {k}, 1, 0))")


def keys(edits: int) -> tuple[str, str]:
    """SQL arrays of index keys and probe keys of ``line`` with ``len`` characters."""
    def key(i: int, start: str, size: str) -> str:
        return f"xxhash64({i}, substring(line, CAST({start} + 1 AS INT), CAST({size} AS INT)))"

    index = [key(i, *segment("len", i, edits)) for i in range(edits + 1)]
    probe = []
    for less in range(edits + 1):
        for i in range(edits + 1):
            start, size = segment(f"(len - {less})", i, edits)
            for shift in range(max(-i, less - (edits - i)), min(i, less + edits - i) + 1):
                probe.append(key(i, f"{start} + {shift}" if shift >= 0 else f"{start} - {-shift}", size))
    return f"array({', '.join(index)})", f"array_distinct(array({', '.join(probe)}))"


def keyed(lines: DataFrame, edits: int, near_chars: int) -> DataFrame:
    """(key, own, h1, len): the first edits + 1 keys of a line are its own segments, the others its probes."""
    index, probe = keys(edits)
    d = lines.select("line", "h1", F.length("line").alias("len")).where(F.col("len") >= max(near_chars, 2 * edits + 2))
    # keys as a column, and "outer": otherwise the planner infers a filter that works all keys out once more
    d = d.select("h1", "len", F.expr(f"concat({index}, {probe})").alias("keys")).select("h1", "len", F.posexplode_outer("keys").alias("at", "key"))
    return d.select("key", (F.col("at") <= edits).alias("own"), "h1", "len")


def parity() -> Column:
    """64 parity bits over the pairs of neighbouring characters of ``chars``."""
    return F.expr("""aggregate(transform(sequence(0, size(chars) - 2), i -> CAST(pmod(hash(chars[i], chars[i + 1]), 64) AS INT)), 0L,
        (a, bit) -> a ^ shiftleft(1L, bit))""")


def within_edits(edits: int) -> Column:
    """Whether char arrays ca and cb are within ``edits`` edits.  Bit t of word d after j characters of cb: the
    first j + t - edits characters of ca are reached with d edits or fewer."""
    band = 2 * edits + 1
    full = (1 << band) - 1
    hits = " | ".join(f"IF(get(ca, j - 1 + {t - edits}) = cb[j - 1], {1 << t}, 0)" for t in range(band))
    names = [f"r{d}" for d in range(edits + 1)]
    first = ", ".join(f"'{n}', {sum(1 << (edits + i) for i in range(d + 1))}" for d, n in enumerate(names))

    def after(d: int, m: str) -> str:
        if not d:
            return f"(s.r0 & {m})"
        return f"(((s.r{d} & {m}) | s.r{d - 1} | shiftright(s.r{d - 1}, 1) | shiftleft({after(d - 1, m)}, 1)) & {full})"

    # the hits of each character first, then the words over them
    word = ", ".join(f"'{n}', {after(d, 'm')}" for d, n in enumerate(names))
    return F.expr(f"""aggregate(transform(sequence(1, size(cb)), j -> {hits}), named_struct({first}), (s, m) -> named_struct({word}),
        s -> (shiftright(s.r{edits}, size(ca) - size(cb) + {edits}) & 1) = 1)""")


def near_links(lines: DataFrame, edits: int = EDITS, near_chars: int = NEAR_CHARS) -> DataFrame:
    """(a1, a2, b1, b2): hashes of two different texts within ``edits`` edits, each pair once."""
    every = stored(keyed(lines, edits, near_chars), "line_keys")
    shared = stored(every.groupBy("key").agg(F.min("h1").alias("lo"), F.max("h1").alias("hi"), F.max("own").alias("own"), F.min("own").alias("all_own"))
                    .where("lo <> hi AND own AND NOT all_own").select("key"), "line_shared")
    rows = stored(every.join(small(shared), "key", "left_semi").distinct(), "line_rows")
    discard(every, shared)
    asked = stored(rows.select("h1").distinct(), "line_asked")
    texts = lines.join(small(asked), "h1", "left_semi").groupBy("h1", "h2").agg(F.first("line").alias("line"))
    texts = stored(texts.withColumn("chars", F.split("line", "")).withColumn("bits", parity()).drop("chars"), "line_texts")
    rows = rows.join(texts.select("h1", "h2", "bits"), "h1")
    a = rows.where("own").select("key", F.col("h1").alias("a1"), F.col("h2").alias("a2"), F.col("len").alias("la"), F.col("bits").alias("bits_a"))
    b = rows.where("NOT own").select("key", F.col("h1").alias("b1"), F.col("h2").alias("b2"), F.col("len").alias("lb"), F.col("bits").alias("bits_b"))
    test = F.expr(f"lb - la BETWEEN 0 AND {edits} AND (lb > la OR b1 > a1 OR (b1 = a1 AND b2 > a2)) AND bit_count(bits_a ^ bits_b) <= {4 * edits}")
    pairs = stored(a.join(b, (a.key == b.key) & test).select("a1", "a2", "b1", "b2").distinct(), "line_pairs")
    of = lambda s: texts.select(F.col("h1").alias(f"{s}1"), F.col("h2").alias(f"{s}2"), F.split("line", "").alias(f"c{s}"))
    links = stored(pairs.join(of("a"), ["a1", "a2"]).join(of("b"), ["b1", "b2"]).where(within_edits(edits)).select("a1", "a2", "b1", "b2"), "line_links")
    discard(pairs, texts, asked)
    return links


def removed_lines(docs: DataFrame, edits: int = EDITS, min_words: int = MIN_WORDS, near_chars: int = NEAR_CHARS) -> DataFrame:
    """doc, text_key, removed (line numbers, in order) and near (how many of them for a line that differs) of documents that lose lines."""
    lines = lines_of(docs, min_words)
    links = near_links(lines, edits, near_chars)
    lines = stored(lines.drop("line"), "line_places")
    firsts = stored(lines.groupBy("h1", "h2").agg(F.min(place()).alias("first"), F.count("*").alias("times")), "line_firsts")
    pick = lambda s: firsts.select(F.col("h1").alias(f"{s}1"), F.col("h2").alias(f"{s}2"), F.col("first").alias(f"first_{s}"))
    both = links.join(pick("a"), ["a1", "a2"]).join(pick("b"), ["b1", "b2"])
    late = both.select(F.expr("IF(first_a < first_b, b1, a1)").alias("h1"), F.expr("IF(first_a < first_b, b2, a2)").alias("h2")).distinct().withColumn("near", F.lit(True))
    told = stored(firsts.join(late, ["h1", "h2"], "left").where("times > 1 OR near"), "line_told")
    gone = lines.join(small(told), ["h1", "h2"]).where(F.col("near") | (place() > F.col("first")))
    return gone.groupBy("doc", "text_key").agg(F.sort_array(F.collect_set("n")).alias("removed"), F.count_distinct(F.when(F.col("near"), F.col("n"))).alias("near"))


def dedup_report(docs: DataFrame, **options) -> DataFrame:
    """doc_id, n_lines, n_removed, n_near and the removed line numbers of every document."""
    d = docs.select("doc_id", text_key().alias("key"), F.coalesce(F.size(F.split("text", "\n")), F.lit(0)).alias("n_lines"))
    same = F.col("doc_id").cast("long").eqNullSafe(F.col("doc")) & (F.col("key") == F.col("text_key"))
    return d.join(removed_lines(docs, **options), same, "left").select(
        "doc_id", F.greatest("n_lines", F.lit(0)).alias("n_lines"), F.coalesce(F.size("removed"), F.lit(0)).alias("n_removed"),
        F.coalesce("near", F.lit(0)).cast("int").alias("n_near"), F.coalesce("removed", F.expr("CAST(array() AS array<int>)")).alias("removed"))


def dedup_lines(docs: DataFrame, keep_share: float = 0.0, **options) -> DataFrame:
    """``docs`` with all its columns, ``text`` without removed lines.  Documents whose characters in lines that
    stay fall below ``keep_share`` of the text's go whole (documents that lose nothing always stay)."""
    gone = removed_lines(docs, **options).select(F.col("doc").alias("__doc"), F.col("text_key").alias("__key"), F.col("removed").alias("__removed"))
    same = F.col("doc_id").cast("long").eqNullSafe(F.col("__doc")) & (F.col("__own") == F.col("__key"))
    d = docs.withColumn("__own", text_key()).join(gone, same, "left")
    d = d.withColumn("__text", F.expr("IF(__removed IS NULL, text, array_join(filter(split(text, '\\n'), (x, i) -> NOT array_contains(__removed, i)), '\\n'))"))
    stay = F.col("__removed").isNull() | ((F.length("__text") > 0) & (F.length("__text") >= keep_share * F.length("text")))
    return d.where(stay).select(*[F.col("__text").alias(c) if c == "text" else F.col(f"`{c}`") for c in docs.columns])
