r"""Document fingerprints by spot signatures.

A spot signature is a common word (or several in a row: the anchor) with the
``CHAIN`` content words that follow it; common words in between are skipped.  The
start of a text is an anchor too.  Common words spread over all prose and hardly
over menus, tables and junk, so the set of signatures stands for a text's prose.
The fingerprint is the sorted set of short digests of the chains.  Likeness is
the Jaccard similarity of two sets.

Words are runs of letters and digits, lower-cased.  A text with words always has a
signature (its start); another text that is not empty has its own digest as
the only one; an empty text has none.

All steps are DataFrame and SQL functions.  Defined results: null text is empty;
two empty sets are alike (1.0), an empty and another one are not (0.0).  A row
whose set has too different a length for the asked likeness is settled by the lengths alone.
``near_classes`` joins all documents with each other: equal sets (copies) are one class, two sets
are compared only if their lengths lie in the same or neighbouring partitions and they share one of their
rarest signatures, and only if lengths and places leave room for the asked likeness.  It links no
document without signatures (null and empty texts are a class of their own); a null id stays a member.
In ``next_texts`` documents follow each other by descending id, rows of one id by
their texts; the first follows the last (a single document follows itself); rows
without id have no next text (an empty one).
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from billow.llm.common import discard, id_and_text, stored

#: Common words of English, Spanish, French and German prose.
COMMON = """
the of and to a in is that it for was on with as be by are this at from
de la que el en y los las se del un por con no una su para es al lo
le et les des du une est pour par dans avec qui pas sur au ou
der die und den von zu das sich mit auf für ist im nicht dem ein eine als
""".split()
CHAIN = 3
#: Hexadecimal digits of a signature.
DIGITS = 8
#: Rows of a page of consecutive ids, and pages at most (sizing only: results do not depend on them).
PAGE_ROWS, PAGES = 1000, 4096
MARK = "\x01"
#: Entries of a (length partition, signature) bucket that meet in one key of the join; larger ones are cut.
BUCKET = 2000


def signatures(df: DataFrame, text: str, out: str, chain: int = CHAIN) -> DataFrame:
    """Adds ``out``: the sorted distinct signatures of the column ``text``."""
    w, c = f"{out}_words", f"{out}_content"
    bare = F.trim(F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}]+", " "))
    anchored = F.regexp_replace(F.concat(F.lit(" "), bare, F.lit(" ")), f"(?<= )({'|'.join(dict.fromkeys(COMMON))}) ", f"$1{MARK}")
    # an element is a content word with the anchor before it, if there is one; whatever a lambda
    # needs is zipped to it, so that nothing is computed again in the loop
    df = df.withColumn(w, F.split(F.concat(F.lit(MARK), F.trim(anchored)), " "))
    df = df.withColumn(c, F.transform(w, lambda x: F.substring_index(x, MARK, -1)))
    later = [F.slice(c, k + 1, F.size(c)).alias(f"c{k}") for k in range(1, chain)]
    chains = F.filter(F.arrays_zip(F.col(w).alias("c0"), *later), lambda x: F.contains(x["c0"], F.lit(MARK)))
    digest = F.transform(chains, lambda x: F.substring(F.md5(F.concat_ws(" ", *[x[f"c{k}"] for k in range(chain)]).cast("binary")), 1, DIGITS))
    no_words = F.size(w) + F.length(F.element_at(w, 1)) == 2
    df = df.withColumn(out, F.when(F.length(text) == 0, F.array().cast("array<string>"))
                       .when(no_words, F.array(F.substring(F.md5(F.col(text).cast("binary")), 1, DIGITS)))
                       .otherwise(F.array_sort(F.array_distinct(digest))))
    return df.drop(w, c)


def fingerprint(sigs: str) -> Column:
    return F.array_join(sigs, "")


def with_likeness(df: DataFrame, a: str, b: str, out: str) -> DataFrame:
    """Adds ``out``: the Jaccard similarity of the signature sets a and b."""
    both = f"{out}_both"
    df = df.withColumn(both, F.when((F.size(a) > 0) & (F.size(b) > 0), F.size(F.array_intersect(a, b))).otherwise(0))
    union = F.size(a) + F.size(b) - F.col(both)
    return df.withColumn(out, F.when(union == 0, 1.0).otherwise(F.col(both).cast("double") / union)).drop(both)


def next_texts(docs: DataFrame, page_rows: int = PAGE_ROWS) -> DataFrame:
    """doc_id, text, sigs, and next_text, next_sigs of the next document by descending id.

    Ids are cut into pages of consecutive ids; the first rows of a page are also sent to the page
    before it, where they come last, so that one window over each page finds every next text."""
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    some, none = rows.where("doc_id IS NOT NULL"), rows.where("doc_id IS NULL")
    n = some.count()
    pages = max(1, min(PAGES, n // page_rows))
    cuts = some.agg(F.percentile_approx("doc_id", [(i + 1) / pages for i in range(pages)], max(10_000, 10 * pages)).alias("cuts")).first().cuts or []

    def page_of(bounds: list[int]) -> Column:
        bounds = F.array(*[F.lit(int(b)) for b in bounds])
        return F.size(bounds) - F.size(F.filter(bounds, lambda b: b >= F.col("doc_id")))

    # the largest id of every page, exactly: one number a page comes to the driver
    tops = sorted(r.top for r in some.groupBy(page_of(sorted(set(cuts))).alias("page")).agg(F.max("doc_id").alias("top")).collect())
    page, last = page_of(tops), max(1, len(tops))
    first = F.array_contains(F.array(*[F.lit(t) for t in tops]).cast("array<bigint>"), F.col("doc_id"))
    here = F.struct(page.alias("page"), F.lit(False).alias("guest"))
    there = F.struct(((page + 1) % last).alias("page"), F.lit(True).alias("guest"))
    dealt = some.withColumn("at", F.explode(F.when(first, F.array(here, there)).otherwise(F.array(here)))).select("doc_id", "text", "at.page", "at.guest")
    signed = signatures(dealt.repartition("page"), "text", "sigs")
    order = Window.partitionBy("page").orderBy("guest", F.desc("doc_id"), "text")
    followed = signed.withColumns({"next_text": F.lead("text").over(order), "next_sigs": F.lead("sigs").over(order)}).where("NOT guest")
    alone = signatures(none, "text", "sigs").withColumns({"next_text": F.lit(""), "next_sigs": F.array().cast("array<string>")})
    cols = ["doc_id", "text", "sigs", "next_text", "next_sigs"]
    return followed.select(cols).unionByName(alone.select(cols))


def edited_fingerprints(docs: DataFrame, page_rows: int = PAGE_ROWS) -> DataFrame:
    """Fingerprints of every text and of its edit: the last third replaced by the beginning of the next text."""
    rows = next_texts(docs, page_rows).withColumn("n_chars", F.length("text").cast("long"))
    third = F.expr("CAST(n_chars div 3 AS INT)")
    rows = rows.withColumn("edited", F.concat(F.substring("text", F.lit(1), F.col("n_chars").cast("int") - third), F.substring("next_text", F.lit(1), third)))
    rows = signatures(rows, "edited", "edited_sigs")
    rows = with_likeness(with_likeness(rows, "sigs", "edited_sigs", "near_edited"), "sigs", "next_sigs", "near_next")
    return rows.select("doc_id", "n_chars", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"), fingerprint("sigs").alias("fingerprint"),
                       fingerprint("edited_sigs").alias("edited_fingerprint"), "near_edited", "near_next")


def length_partition(n: str, percent: int) -> Column:
    """Partitions of set lengths, each as wide as the lengths a set may be alike to: a set's partners of
    its length or longer lie in its own partition or the next."""
    return F.floor(F.log(F.col(n)) / math.log(100 / percent) + 1e-9).cast("int")


def rare_entries(classes: DataFrame, percent: int) -> DataFrame:
    """key, n, sig, place, part: of every set its rarest signatures, as many as two sets of this likeness must share one of."""
    entries = classes.select("key", "n", F.explode("sigs").alias("sig"))
    ranked = entries.join(entries.groupBy("sig").agg(F.count("*").alias("c")), "sig") \
        .withColumn("place", F.row_number().over(Window.partitionBy("key").orderBy("c", "sig")))
    return ranked.where(100 * F.col("place") <= (100 - percent) * F.col("n") + 100).select(
        "key", "n", "sig", "place", length_partition("n", percent).alias("part"))


def near_classes(docs: DataFrame, percent: int = 80) -> tuple[DataFrame, DataFrame]:
    """(members: doc_id, key, n; pairs: a, b, likeness) of all documents whose signature sets have a Jaccard
    similarity of ``percent`` or more.  Documents of one ``key`` have equal sets of n signatures; a pair links two keys, a < b."""
    signed = signatures(id_and_text(docs), "text", "sigs").select("doc_id", "sigs", F.md5(fingerprint("sigs").cast("binary")).alias("key"), F.size("sigs").alias("n"))
    signed = stored(signed, "spot_signed")
    classes = stored(signed.where("n > 0").groupBy("key").agg(F.any_value("sigs").alias("sigs"), F.any_value("n").alias("n")), "spot_classes")
    entries = stored(rare_entries(classes, percent), "spot_entries")
    # a set meets those of its own partition and, as the shorter one, those of the next
    probes = entries.withColumn("part", F.explode(F.array("part", F.col("part") + 1)))
    cuts = entries.groupBy("part", "sig").agg(F.ceil(F.count("*") / BUCKET).cast("int").alias("cuts")).where("cuts > 1")
    index = entries.join(cuts, ["part", "sig"], "left").withColumn("cut", F.expr("pmod(xxhash64(key), coalesce(cuts, 1))"))
    probes = probes.join(cuts, ["part", "sig"], "left").withColumn("cut", F.explode(F.expr("sequence(0L, coalesce(cuts, 1) - 1L)")))
    x, y = (df.select("part", "sig", "cut", *[F.col(c).alias(f"{c}_{side}") for c in ("key", "n", "place")]) for df, side in ((probes, "x"), (index, "y")))
    room = 1 + F.least(F.col("n_x") - F.col("place_x"), F.col("n_y") - F.col("place_y"))
    met = x.join(y, ["part", "sig", "cut"]).where((F.col("n_x") < F.col("n_y")) | ((F.col("n_x") == F.col("n_y")) & (F.col("key_x") < F.col("key_y")))) \
        .where(100 * F.col("n_x") >= percent * F.col("n_y")) \
        .where((100 + percent) * (room + F.least("place_x", "place_y") - 1) >= percent * (F.col("n_x") + F.col("n_y")))
    met = met.select(F.least("key_x", "key_y").alias("a"), F.greatest("key_x", "key_y").alias("b")).distinct()
    sets = lambda k: classes.select(F.col("key").alias(k), F.col("sigs").alias(f"sigs_{k}"))
    both = met.join(sets("a"), "a").join(sets("b"), "b").withColumn("both", F.size(F.array_intersect("sigs_a", "sigs_b")))
    both = both.withColumn("all", F.size("sigs_a") + F.size("sigs_b") - F.col("both")).where(100 * F.col("both") >= percent * F.col("all"))
    pairs = stored(both.select("a", "b", (F.col("both").cast("double") / F.col("all")).alias("likeness")), "spot_pairs")
    discard(classes, entries)
    return signed.select("doc_id", "key", "n"), pairs
