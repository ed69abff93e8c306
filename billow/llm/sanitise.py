"""Personal data and the words that give it away.

*Base.*  E-mail addresses, IP addresses, payment-card and phone numbers are found
by patterns in every whole text.  The patterns run in linear time: possessive
repeats, and starts only where a leftmost match can start.

*Method.*  The found values are protected, and so is what they have in common: an
entity is a value itself, its domain, network, issuer or area (``VIEWS``), its
kind, or any of them.  Over the distinct texts of the whole corpus, an entity e has the
information content IC = -log2(texts(e) / texts).  A term t that stands in texts
with e says of it PMI = log2(share / (texts(e) / texts)), where share =
both(t, e) / (texts(t) + ``PRIOR``) leans rare terms towards saying nothing.  A term
discloses e where PMI >= ``ALPHA`` * IC, in at least ``SUPPORT`` texts with e that do
not all have it from the same line (as copies have).  Disclosing terms are
spans of kind ``term`` wherever they occur.

A term is a lower-cased word with a letter, without punctuation at its ends; words
with an @ are none.

``sanitise`` rewrites the texts: base spans become their kind in brackets, a
disclosing term becomes its generalisation where the caller's table has one that
does not disclose itself, and is removed otherwise.

All steps are DataFrame and SQL functions.  Defined results: null text is empty
and has no spans; repeated rows have the spans of their text each; spans count
code points, end exclusive; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from billow.llm.common import WS, stored

ALPHA = 0.8
SUPPORT = 6
PRIOR = 2
#: Rows of a lookup that Spark is asked to broadcast at most; beyond, it joins by shuffle.
BROADCAST_ROWS = 100_000
KINDS = ("email", "ip", "card", "phone", "term")
# Same matches as the stated patterns, without their backtracking.
PATTERNS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"(?<![0-9])(?<![0-9][\x20-])(?=(?:[0-9][\x20-]?){11}[0-9])[0-9]++(?:[\x20-][0-9]++)*+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: A text without these holds no such match.
NEEDS = {"email": "text LIKE '%@%'", "ip": r"text RLIKE '[0-9]\\.[0-9]'", "card": r"text RLIKE '[0-9](?:[\\x20-]?[0-9]){11}'", "phone": "text LIKE '%+%'"}
VALID = {
    "email": "true",
    "ip": "forall(split(m, '[.]'), x -> length(ltrim('0', x)) <= 3 AND CAST(CONCAT('0', ltrim('0', x)) AS BIGINT) <= 255)",
    "card": """length(regexp_replace(m, '[^0-9]', '')) BETWEEN 12 AND 19 AND aggregate(
        transform(split(reverse(regexp_replace(m, '[^0-9]', '')), ''), (x, i) -> IF(i % 2 = 0, CAST(x AS INT), (2 * CAST(x AS INT)) div 10 + (2 * CAST(x AS INT)) % 10)),
        0L, (a, x) -> a + x) % 10 = 0""",
    "phone": "length(regexp_replace(m, '[^0-9]', '')) BETWEEN 9 AND 15",
}
#: What several values share, by kind.
VIEWS = {"email": "lower(substring_index(s.m, '@', -1))", "ip": "substring_index(s.m, '.', 2)", "card": "left(regexp_replace(s.m, '[^0-9]', ''), 6)",
         "phone": "left(regexp_replace(s.m, '[^0-9]', ''), 4)"}
STEP = 256
SPAN = "struct<start:bigint,kind:int,end:bigint,m:string>"


def literal(pattern: str) -> str:
    return "'" + pattern.replace("\\", "\\\\") + "'"


def with_spans(df: DataFrame, name: str, needs: str, pattern: str, kind: int, valid: str) -> DataFrame:
    """Adds ``name``: all valid matches of the SQL expression ``pattern`` in ``text`` as (start, kind, end, text).

    The texts between matches give the positions; lengths are summed in steps of ``STEP`` matches, so that
    the work grows little faster than the number of matches."""
    a, b, c = f"{name}_m", f"{name}_gap", f"{name}_len"
    df = df.withColumn(a, F.expr(f"IF({needs}, regexp_extract_all(text, {pattern}, 0), array())"))
    df = df.withColumn(b, F.expr(f"IF(size({a}) > 0, split(text, {pattern}, -1), array())"))
    # whatever a loop reads is named twice, so that the optimizer keeps it a column and does not repeat it in the loop
    df = df.withColumn(c, F.expr(f"IF(size({a}) > 0 AND size({b}) > 0, transform({a}, (m, i) -> CAST(length(m) + length({b}[i]) AS BIGINT)), array())"))
    df = df.withColumn(f"{name}_sum", F.expr(f"""IF(size({c}) > 0, transform(sequence(0, (size({c}) - 1) div {STEP}),
        s -> aggregate(slice({c}, CAST(s * {STEP} + 1 AS INT), {STEP}), 0L, (x, y) -> x + y)), array())"""))
    df = df.withColumn(f"{name}_end", F.expr(f"""IF(size({name}_sum) = 0, array(), transform({c}, (y, i) -> {c}[i]
        + aggregate(slice({name}_sum, 1, CAST(i div {STEP} AS INT)), 0L, (p, q) -> p + q)
        + aggregate(slice({c}, CAST((i div {STEP}) * {STEP} + 1 AS INT), i % {STEP}), 0L, (p, q) -> p + q)))"""))
    df = df.withColumn(name, F.expr(f"""filter(transform({a}, (m, i) -> IF({valid},
        named_struct('start', {name}_end[i] - length(m), 'kind', {kind}, 'end', {name}_end[i], 'm', m), NULL)), x -> x IS NOT NULL)"""))
    return df.drop(a, b, c, f"{name}_sum", f"{name}_end")


def base_spans(df: DataFrame, text_needed: bool = True) -> DataFrame:
    """Adds email, ip, card and phone spans of ``text`` and all of them in order as ``base``."""
    for i, (kind, pattern) in enumerate(PATTERNS.items()):
        df = with_spans(df, kind, NEEDS[kind], literal(pattern), i, VALID[kind])
    df = df.withColumn("base", F.array_sort(F.concat(*PATTERNS)))
    return df if text_needed else df.drop("text")


def joined(spans: str) -> Column:
    names = "array(" + ", ".join(f"'{k}'" for k in KINDS) + ")"
    return F.expr(f"concat_ws(',', transform({spans}, s -> concat({names}[s.kind], ':', s.start, ':', s.end)))")


def terms(text: Column | str) -> Column:
    """Distinct words with a letter, lower-cased, without punctuation at their ends; none with an @."""
    bare = F.regexp_replace(F.lower(F.col(text) if isinstance(text, str) else text), r"[^\p{L}\p{N}\x20\x09-\x0D]++(?=[\x20\x09-\x0D]|$)|(?<![^\x20\x09-\x0D])[^\p{L}\p{N}\x20\x09-\x0D]++", "")
    return F.filter(F.array_distinct(F.split(bare, WS)), lambda w: w.rlike(r"\p{L}") & ~F.contains(w, F.lit("@")))


def row_keys(docs: DataFrame) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    return docs.withColumns({"k1": F.xxhash64(text), "k2": F.xxhash64(F.lit(1), text)})


def entities(spans: str = "base") -> Column:
    """Hashes of the values, what they share, their kinds, and of any of them."""
    view = "CASE s.kind " + " ".join(f"WHEN {i} THEN {VIEWS[k]}" for i, k in enumerate(PATTERNS)) + " END"
    return F.expr(f"""IF(size({spans}) = 0, array(), array_distinct(concat(array(xxhash64('any')), flatten(transform({spans}, s -> array(
        xxhash64('value', s.kind, lower(s.m)), xxhash64('view', s.kind, {view}), xxhash64('kind', s.kind)))))))""")


def _bounded(df: DataFrame) -> DataFrame:
    """``df`` (a stored table), broadcast if it has at most ``BROADCAST_ROWS`` rows."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def disclosing_terms(docs: DataFrame, alpha: float = ALPHA, support: int = SUPPORT) -> DataFrame:
    """term, entity (hash), share of the term's texts that hold the entity, for terms that disclose an entity."""
    rows = row_keys(docs.select(F.coalesce("text", F.lit("")).alias("text")))
    # how many rows hold a text: each then counts as one part of it, and the parts of n texts sum to n
    copies = stored(rows.groupBy("k1", "k2").agg(F.count("*").alias("copies")), "pii_keys")
    n, copies = copies.count(), _bounded(stored(copies.where("copies > 1"), "pii_copies"))
    # texts without a valid match end with no entity: a filter on the spans would be pushed down and repeat them
    marked = base_spans(rows.where(" OR ".join(f"({n})" for n in NEEDS.values())))
    held = stored(marked.select("k1", "k2", "text", entities().alias("entities")), "pii_held").where("size(entities) > 0")
    held = stored(held.groupBy("k1", "k2").agg(F.first("text").alias("text"), F.first("entities").alias("entities")), "pii_texts")
    each = held.select("k1", "k2", F.explode("entities").alias("entity"))
    of_entity = stored(each.groupBy("entity").agg(F.count("*").alias("of_entity")).where(F.col("of_entity") >= support), "pii_of_entity")
    # entities of too few texts go before they meet terms
    common = each.join(_bounded(of_entity), "entity").groupBy("k1", "k2").agg(F.collect_list("entity").alias("common"))
    lines = held.select("k1", "k2", "text").join(common, ["k1", "k2"]).select("k1", "common", F.explode(F.split("text", "\n")).alias("line"))
    words = lines.select("k1", "common", F.xxhash64("line").alias("line"), F.explode(terms("line")).alias("term"))
    # a term once for each text, with the smallest hash of the lines that hold it there
    words = words.groupBy("k1", "term").agg(F.first("common").alias("common"), F.min("line").alias("line"))
    pairs = words.select("term", "line", F.explode("common").alias("entity")).groupBy("entity", "term").agg(
        F.count("*").alias("both"), F.min("line").alias("least"), F.max("line").alias("most"))
    pairs = stored(pairs.where((F.col("both") >= support) & (F.col("least") < F.col("most"))).select("entity", "term", "both").join(of_entity, "entity"), "pii_pairs")
    asked = _bounded(stored(pairs.select("term").distinct(), "pii_asked"))
    parts = rows.join(copies, ["k1", "k2"], "left").select(F.explode(terms("text")).alias("term"), (F.lit(1.0) / F.coalesce("copies", F.lit(1))).alias("part"))
    of_term = parts.join(asked, "term", "left_semi").groupBy("term").agg(F.round(F.sum("part")).cast("long").alias("of_term"))
    share = F.col("both") / (F.col("of_term") + PRIOR)
    pmi = pairs.join(of_term, "term").withColumns({"share": share, "pmi": F.log2(n * share / F.col("of_entity")), "ic": -F.log2(F.col("of_entity") / n)})
    return stored(pmi.where((F.col("ic") > 0) & (F.col("pmi") >= alpha * F.col("ic"))).select("term", "entity", "share"), "pii_terms")


def term_spans(docs: DataFrame, found: DataFrame) -> DataFrame:
    """k1, k2 (text key) and term_spans of every text that holds a disclosing term."""
    asked = _bounded(stored(found.select("term").distinct(), "pii_found"))
    rows = row_keys(docs.select(F.coalesce("text", F.lit("")).alias("text")))
    hits = rows.select("k1", "k2", F.explode(terms("text")).alias("term")).join(asked, "term").distinct().groupBy("k1", "k2").agg(F.sort_array(F.collect_list("term")).alias("terms"))
    kept = rows.join(_bounded(stored(hits, "pii_hits")), ["k1", "k2"]).groupBy("k1", "k2").agg(F.first("text").alias("text"), F.first("terms").alias("terms"))
    # term words hold letters, digits and inner punctuation: quoted, longest first, case folded as lower() does
    kept = kept.withColumn("pattern", F.expr(r"""concat('(?iu)(?<![\\p{L}\\p{N}])(?:', array_join(transform(array_sort(terms, (x, y) -> length(y) - length(x)),
        t -> regexp_replace(t, '([^\\p{L}\\p{N}])', '\\\\$1')), '|'), ')(?![\\p{L}\\p{N}])')"""))
    spans = with_spans(base_spans(kept), "term_spans", "true", "pattern", KINDS.index("term"), "true")
    return spans.select("k1", "k2", F.expr("filter(term_spans, t -> NOT exists(base, b -> t.start < b.end AND b.start < t.end))").alias("term_spans"))


def all_spans(docs: DataFrame, alpha: float = ALPHA, support: int = SUPPORT) -> tuple[DataFrame, DataFrame]:
    """(doc_id, text, base span arrays and term_spans of every row, disclosing terms)."""
    found = disclosing_terms(docs, alpha, support)
    rows = row_keys(base_spans(docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))))
    if found.isEmpty():
        return rows.withColumn("term_spans", F.expr(f"CAST(array() AS array<{SPAN}>)")), found
    more = _bounded(stored(term_spans(docs, found), "pii_term_spans"))
    rows = rows.join(more, ["k1", "k2"], "left").withColumn("term_spans", F.coalesce("term_spans", F.expr(f"CAST(array() AS array<{SPAN}>)")))
    return rows, found


def find_personal_data(docs: DataFrame, alpha: float = ALPHA, support: int = SUPPORT) -> DataFrame:
    """doc_id, counts by kind, digest of the base spans, all spans, and the numbers of disclosing terms and of all spans."""
    rows, _ = all_spans(docs, alpha, support)
    rows = rows.withColumn("every", F.expr("array_sort(concat(base, term_spans))"))
    return rows.select("doc_id", *[F.size(k).cast("long").alias(f"n_{k}") for k in PATTERNS], F.sha2(joined("base"), 256).alias("base_sha256"),
                       joined("every").alias("spans"), F.size("term_spans").cast("long").alias("n_term"), F.size("every").cast("long").alias("n_spans"))


def sanitise(docs: DataFrame, generalisations: DataFrame | None = None, alpha: float = ALPHA, support: int = SUPPORT) -> DataFrame:
    """doc_id and the text without personal data and disclosing terms.  generalisations: (term, general), at most
    ``BROADCAST_ROWS`` rows; of several for a term the alphabetically first that does not disclose anything."""
    rows, found = all_spans(docs, alpha, support)
    table = F.expr("map()").cast("map<string,string>")
    if generalisations is not None:
        usable = generalisations.select(F.lower("term").alias("term"), "general").where("term IS NOT NULL AND general IS NOT NULL")
        usable = usable.join(found.select(F.col("term").alias("general")).distinct(), "general", "left_anti").groupBy("term").agg(F.min("general").alias("general"))
        usable = usable.agg(F.map_from_entries(F.collect_list(F.struct("term", "general"))).alias("general_of"))
        rows = rows.join(F.broadcast(usable), F.lit(True))  # one row
    else:
        rows = rows.withColumn("general_of", table)
    names = "array(" + ", ".join(f"'[{k.upper()}]'" for k in KINDS[:4]) + ")"
    text = F.expr(f"""aggregate(array_sort(concat(base, term_spans)), named_struct('at', 0L, 'out', ''),
        (a, s) -> IF(s.start >= a.at, named_struct('at', s.end, 'out', concat(a.out, substring(text, CAST(a.at + 1 AS INT), CAST(s.start - a.at AS INT)),
            IF(s.kind < 4, {names}[least(s.kind, 3)], coalesce(general_of[lower(s.m)], '')))), named_struct('at', greatest(a.at, s.end), 'out', a.out)),
        a -> concat(a.out, substring(text, CAST(a.at + 1 AS INT))))""")
    return rows.select("doc_id", text.alias("text"))
