"""Grouped prefix join: near-duplicate documents by the Jaccard similarity of their word n-grams.

A document's set holds 64-bit hashes of its distinct word n-grams.  Steps:

1. *Order.*  All n-grams of all documents are counted into ``COUNTERS`` hash
   counters (a fixed number, so their table is bounded).  Every set is sorted by
   (level of its n-gram's counter above the usual, hash): common n-grams last.
   Any fixed order keeps the join exact; this one keeps passages that many
   documents share out of the prefixes.
2. *Classes and groups.*  Equal sets form a class.  Classes with equal size and
   equal prefix form a group; the join sees each group once.
3. *Prefix join.*  Two similar sets share a prefix n-gram.  Prefix entries travel
   as packed arrays by hash range; a range's runs of equal n-grams give group
   pairs that pass the size and position filters.
4. *Expand and verify.*  Group pairs expand to class pairs, parity bitmaps drop
   those that differ too much (a lower bound of the difference, so no link is
   lost).  Sets of more n-grams than a bitmap has bits would pass it whatever they
   hold: their pairs go by sketches, bitmaps as long as the set, in the same way.
   The rest are compared set with set: each class's nearest one first,
   then the nearest of two components, then all whose components are still apart
   (a pair within a component cannot change it).
5. *Long runs.*  In a run of more than ``RUN`` groups each one is first paired with
   one group of the run only.  Once links and components are known, what is left,
   pairs across components, is filtered by bitmaps in blocks of ``BLOCK`` members,
   then by sketches, and verified in the same order.  No pair is left out for a run's length.
6. *Components* give each document the smallest doc_id that links reach.

Defined results: null or empty texts and texts without words have an empty set,
0 n-grams and their own doc_id as component; a text of fewer than n words is one
n-gram; repeated rows are equal sets; rows with null doc_id take part by their
text and report the smallest known doc_id of their component (null if none).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from billow.llm.common import discard, id_and_text, stored
from billow.llm.components import connected_components

COUNTERS = 1 << 20
CHUNK = 1 << 12
#: Packed ranges of hashes per partition of the input.
RANGES = 8
RUN = 8
BLOCK = 2000
#: Class ids that may be broadcast as a filter; beyond, Spark joins by shuffle.
BROADCAST_ROWS = 1_000_000
BITMAP_BYTES = 64
#: Remembered word hashes per Python worker.
MEMO_WORDS = 300_000
#: Remembered n-gram sets per task that compares pairs.
MEMO_SETS = 500
_memo: dict[bytes, int] = {}


def word_hashes(words: list[bytes]) -> np.ndarray:
    if len(_memo) > MEMO_WORDS:
        _memo.clear()
    for w in set(words).difference(_memo):
        _memo[w] = xxhash.xxh64_intdigest(w)
    return np.fromiter(map(_memo.__getitem__, words), np.uint64, len(words))


def ngram_set(text: str, n: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the text's word n-grams (bytes.split cuts at ASCII white space,
    bytes.lower folds A-Z only)."""
    h = word_hashes(text.encode("utf-8", "surrogatepass").lower().split())
    if not len(h):
        return h
    k = min(n, len(h))
    out = np.full(len(h) - k + 1, k, np.uint64)
    for i in range(k):
        out = (out ^ (out >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15) + h[i:len(h) - k + 1 + i]
    out = (out ^ (out >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return np.unique(out ^ (out >> np.uint64(32)))


def levels(counts: np.ndarray) -> np.ndarray:
    """0 for a usual counter; else the doublings of its excess over the mean and five deviations of chance."""
    usual = counts.mean() + 5 * np.sqrt(counts.mean()) + 5
    return np.ceil(np.log2(np.maximum(counts / usual, 1))).astype(np.uint8)


def ngram_levels(texts: DataFrame, n: int) -> np.ndarray:
    """Level of each of the ``COUNTERS`` counters over all n-grams of all documents."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(COUNTERS, np.int64)
        for b in batches:
            sets = [ngram_set(t, n) for t in b.text]
            for i in range(0, len(sets), 500):
                total += np.bincount((np.concatenate(sets[i:i + 500]) % np.uint64(COUNTERS)).astype(np.int64), minlength=COUNTERS)
        chunks = total.astype(np.uint32).reshape(-1, CHUNK)
        some = np.flatnonzero(chunks.any(1))
        yield pd.DataFrame({"chunk": some, "counts": [chunks[i].tobytes() for i in some]})

    def add(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[int, np.ndarray] = {}
        for b in batches:
            for chunk, counts in zip(b.chunk, b.counts):
                sums[chunk] = sums.get(chunk, 0) + np.frombuffer(counts, np.uint32).astype(np.int64)
        yield pd.DataFrame({"chunk": list(sums), "counts": [s.tobytes() for s in sums.values()]})

    parts = texts.select("text").mapInPandas(count, "chunk int, counts binary").repartition("chunk")
    counts = np.zeros((COUNTERS // CHUNK, CHUNK), np.int64)
    for row in parts.mapInPandas(add, "chunk int, counts binary").toLocalIterator():  # 256 chunks at most
        counts[row.chunk] = np.frombuffer(row.counts, np.int64)
    return levels(counts.ravel())


def parity(s: np.ndarray) -> bytes:
    bits = np.bincount((s >> np.uint64(40)).astype(np.int64) % (8 * BITMAP_BYTES), minlength=8 * BITMAP_BYTES) & 1
    return np.packbits(bits.astype(np.uint8)).tobytes()


def sketch(s: np.ndarray) -> bytes:
    """Parity bitmap of a set too large for ``parity``, with as many bits as it has elements, rounded up to a
    power of two; else nothing."""
    if len(s) <= 8 * BITMAP_BYTES:
        return b""
    bits = 1 << (len(s) - 1).bit_length()
    odd = np.bincount((s >> np.uint64(20)).astype(np.int64) & (bits - 1), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8)).tobytes()


def sketches_apart(a: bytes, b: bytes) -> int:
    """Bits in which two sketches differ, the longer one folded to the other's length: at most the sets' difference."""
    x, y = sorted((np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)), key=len)
    while len(y) > len(x):
        y = y[:len(y) // 2] ^ y[len(y) // 2:]
    return int(np.bitwise_count(x ^ y).sum())


def needed(total: np.ndarray, percent: int) -> np.ndarray:
    """Smallest intersection that two sets of ``total`` elements together need: 100 i >= percent (total - i)."""
    return -(-percent * total // (100 + percent))


def signatures(texts: DataFrame, level: np.ndarray, n: int, percent: int) -> DataFrame:
    """doc_id, size, class id, group id, prefix, parity bitmap and sketch per document."""

    def sign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for text in b.text:
                s = ngram_set(text, n)
                size = len(s)
                order = np.argsort(level[(s % np.uint64(COUNTERS)).astype(np.int64)], kind="stable")
                prefix = s[order[:size - -(-percent * size // 100) + 1]].tobytes() if size else b""
                gid = int.from_bytes(xxhash.xxh64_digest(prefix, size), "little", signed=True)
                rows.append((size, xxhash.xxh128_digest(s.tobytes()), gid, prefix, parity(s), sketch(s)))
            made = pd.DataFrame(rows, columns=["size", "cid", "gid", "prefix", "bits", "sketch"], index=b.index)
            yield pd.concat([b.drop(columns="text").astype({"doc_id": "Int64"}), made], axis=1)

    return texts.select("doc_id", "row_key", "text_key", "text").mapInPandas(
        sign, "doc_id long, row_key long, text_key long, size long, cid binary, gid long, prefix binary, bits binary, sketch binary")


ENTRY = np.dtype([("token", "<u8"), ("gid", "<i8"), ("size", "<i4"), ("pos", "<i4")])


def entries(groups: DataFrame, ranges: int) -> DataFrame:
    """Prefix entries of each group, packed by hash range."""

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            tokens = np.frombuffer(b"".join(b.prefix), np.uint64)
            lens = b.prefix.map(len).to_numpy() // 8
            e = np.empty(len(tokens), ENTRY)
            e["token"], e["gid"], e["size"] = tokens, np.repeat(b.gid.to_numpy(), lens), np.repeat(b["size"].to_numpy(), lens)
            e["pos"] = np.arange(len(tokens)) - np.repeat(np.cumsum(lens) - lens, lens)
            part = ((tokens >> np.uint64(32)) * np.uint64(ranges) >> np.uint64(32)).astype(np.int64)
            order = np.argsort(part, kind="stable")
            cuts = np.searchsorted(part[order], np.arange(ranges + 1))
            some = np.flatnonzero(np.diff(cuts))
            yield pd.DataFrame({"part": some, "packed": [e[order[cuts[i]:cuts[i + 1]]].tobytes() for i in some]})

    return groups.select("gid", "size", "prefix").mapInPandas(pack, "part int, packed binary")


def may_link(a: np.ndarray, b: np.ndarray, percent: int) -> np.ndarray:
    """Size and position filters of entry pairs of one n-gram.  The position bound holds for the first
    n-gram that two similar sets share, and that one pair of entries is enough."""
    lo, hi = np.minimum(a["size"], b["size"]).astype(np.int64), np.maximum(a["size"], b["size"]).astype(np.int64)
    rest = np.minimum(a["size"] - a["pos"], b["size"] - b["pos"])
    return (100 * lo >= percent * hi) & (rest >= needed(lo + hi, percent))


def run_pairs(packed: DataFrame, percent: int) -> DataFrame:
    """Rows (a, b) for group pairs of short runs, and (a, token, pos, length) for members of long runs."""

    def runs(part: pd.DataFrame) -> pd.DataFrame:
        e = np.frombuffer(b"".join(part.packed), ENTRY)
        e = e[np.lexsort((e["gid"], e["size"], e["token"]))]
        starts = runs_of(e["token"])
        lens = np.diff(np.r_[starts, len(e)])
        length = np.repeat(lens, lens)
        found = []
        for gap in range(1, RUN):
            at = np.flatnonzero((e["token"][:-gap] == e["token"][gap:]) & (length[gap:] <= RUN))
            if not len(at):
                break
            a, b = e[at], e[at + gap]
            ok = may_link(a, b, percent)
            found.append(np.stack([a["gid"][ok], b["gid"][ok]], 1))
        pairs = np.unique(np.sort(np.concatenate(found or [np.empty((0, 2), np.int64)]), axis=1), axis=0)
        out = [pd.DataFrame({"a": pairs[:, 0], "b": pairs[:, 1]})]
        long = np.flatnonzero(length > RUN)
        if len(long):
            r = e[long]
            first = np.minimum.reduceat(r["gid"], runs_of(r["token"]))  # the same group leads the runs of a cluster
            stars = np.unique(np.stack([r["gid"], np.repeat(first, lens[lens > RUN])], 1), axis=0)
            out.append(pd.DataFrame({"a": stars[:, 0], "b": stars[:, 1]}))
            out.append(pd.DataFrame({"a": r["gid"], "token": r["token"].astype(np.int64), "pos": r["pos"].astype(np.int64), "length": length[long]}))
        names = ["a", "b", "token", "pos", "length"]  # nullable whole numbers throughout: hashes don't fit doubles
        return pd.concat([x.astype("Int64").reindex(columns=names).astype("Int64") for x in out]).assign(part=part.part.iloc[0])

    return packed.groupBy("part").applyInPandas(runs, "part int, a long, b long, token long, pos long, length long")


def runs_of(column: np.ndarray) -> np.ndarray:
    """Start of each run of equal values."""
    return np.flatnonzero(np.r_[True, column[1:] != column[:-1]])


def bits_apart(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.bitwise_count(a ^ b).sum(-1)


def as_bits(column: pd.Series) -> np.ndarray:
    return np.frombuffer(b"".join(column), np.uint64).reshape(-1, BITMAP_BYTES // 8)


def bitmap_filter(pairs: DataFrame, percent: int) -> DataFrame:
    """Class pairs whose bitmaps and sizes leave a similarity of ``percent`` possible; room: by how many bits."""

    def keep(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            total = (b.size_a + b.size_b).to_numpy()
            room = total - 2 * needed(total, percent) - bits_apart(as_bits(b.bits_a), as_bits(b.bits_b))
            yield b.assign(room=room).loc[room >= 0, ["a", "b", "room"]]

    return pairs.mapInPandas(keep, "a binary, b binary, room long")


def sketch_filter(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Class pairs (a, b, room) whose sketches leave a similarity of ``percent`` possible; those of sets without
    sketch pass."""

    def keep(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            some = b[b.size_a.notna() & b.size_b.notna()]
            total = (some.size_a + some.size_b).to_numpy(np.int64)
            apart = np.fromiter(map(sketches_apart, some.sketch_a, some.sketch_b), np.int64, len(some))
            room = b.room.copy()
            room[some.index] = np.minimum(some.room, total - 2 * needed(total, percent) - apart)
            yield b.assign(room=room).loc[room >= 0, ["a", "b", "room"]]

    large = classes.where(F.length("sketch") > 0)
    for s in ("a", "b"):
        pairs = pairs.join(large.select(F.col("cid").alias(s), F.col("size").alias(f"size_{s}"), F.col("sketch").alias(f"sketch_{s}")), s, "left")
    return pairs.mapInPandas(keep, "a binary, b binary, room long")


def side(classes: DataFrame, which: str) -> DataFrame:
    return classes.select(F.col("gid").alias(f"gid_{which}"), F.col("cid").alias(which), F.col("size").alias(f"size_{which}"),
                          F.col("bits").alias(f"bits_{which}"))


def expand(group_pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Group pairs -> distinct class pairs (a < b, room) that pass the bitmap filter."""
    p = group_pairs.select(F.col("a").alias("gid_a"), F.col("b").alias("gid_b")).distinct()
    p = p.join(side(classes, "a"), "gid_a").join(side(classes, "b"), "gid_b").where("gid_a <> gid_b OR a < b") \
        .where(f"100 * least(size_a, size_b) >= {percent} * greatest(size_a, size_b)")  # the pairs of long runs come unfiltered
    return bitmap_filter(p, percent).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), "room").distinct()


def nearest_each(pairs: DataFrame) -> DataFrame:
    """Of each class's pairs the one with most room."""
    both = pairs.select(F.col("a").alias("x"), "a", "b", "room").union(pairs.select(F.col("b"), "a", "b", "room"))
    return both.groupBy("x").agg(F.max_by(F.struct("a", "b"), F.struct("room", "a", "b")).alias("p")).select("p.*").distinct()


def apart(pairs: DataFrame, labels: DataFrame, best: bool) -> DataFrame:
    """Pairs whose classes are in different components; with ``best`` the one with most room of two components."""
    side = lambda s: labels.select(F.col("node").alias(s), F.col("label").alias(f"l{s}"))
    left = pairs.join(side("a"), "a", "left").join(side("b"), "b", "left").withColumns({"la": F.coalesce("la", "a"), "lb": F.coalesce("lb", "b")}).where("la <> lb")
    if best:
        left = left.groupBy(F.least("la", "lb").alias("x"), F.greatest("la", "lb").alias("y")).agg(
            F.max_by(F.struct("a", "b"), F.struct("room", "a", "b")).alias("p")).select("p.*")
    return left.select("a", "b")


def verify(pairs: DataFrame, classes: DataFrame, texts: DataFrame, n: int, percent: int) -> DataFrame:
    """The class pairs that are links, by comparing their sets (of one document of each class)."""
    pairs = stored(pairs, "ngram_pairs")
    ids = pairs.select(F.col("a").alias("cid")).union(pairs.select("b")).distinct()
    wanted = told = stored(classes.join(ids, "cid").select("cid", "row.*"), "ngram_wanted")
    if wanted.count() <= BROADCAST_ROWS:
        wanted = F.broadcast(wanted)

    # texts travel, which compress; their sets of hashes take several times the disk
    found = stored(texts.join(wanted, ["row_key", "text_key"]).select("cid", "text").dropDuplicates(["cid"]), "ngram_texts")

    def similar(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sets: dict[bytes, np.ndarray] = {}

        def set_of(cid: bytes, text: str) -> np.ndarray:
            if len(sets) > MEMO_SETS:
                sets.clear()
            if cid not in sets:
                sets[cid] = ngram_set(text, n)
            return sets[cid]

        for b in batches:
            ok = []
            for row in b.itertuples():
                x, y = set_of(row.a, row.text_a), set_of(row.b, row.text_b)
                both = len(np.intersect1d(x, y, assume_unique=True))
                ok.append(100 * both >= percent * (len(x) + len(y) - both))
            yield b.loc[ok, ["a", "b"]]

    both = pairs.join(found.select(F.col("cid").alias("a"), F.col("text").alias("text_a")), "a") \
        .join(found.select(F.col("cid").alias("b"), F.col("text").alias("text_b")), "b")
    links = stored(both.mapInPandas(similar, "a binary, b binary"), "ngram_links")
    discard(pairs, told, found)
    return links


def left_over(members: DataFrame, classes: DataFrame, labels: DataFrame, percent: int, best: bool) -> DataFrame:
    """Class pairs of long runs across components, filtered block against block; with ``best`` the nearest of
    two components only."""
    known = classes.join(labels.withColumnRenamed("node", "cid"), "cid", "left") \
        .select("gid", "cid", "size", "bits", F.coalesce("label", "cid").alias("label"))
    rows = members.select(F.col("a").alias("gid"), "part", "token", "pos", F.ceil(F.col("length") / BLOCK).alias("blocks")).join(known, "gid")
    rows = rows.withColumn("own", F.expr("pmod(xxhash64(cid), blocks)")).withColumn("other", F.expr("explode(sequence(0L, blocks - 1))")).select(
        "part", "token", F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi"), "own", "cid", "size", "pos", "bits", "label")

    def block(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("token", kind="stable")
        label, _ = pd.factorize(pdf.label)
        token, own, size, pos = (pdf[c].to_numpy() for c in ("token", "own", "size", "pos"))
        bits, cid, names = as_bits(pdf.bits), pdf.cid.to_numpy(), pdf.label.to_numpy()
        lo, hi, out = pdf.lo.iloc[0], pdf.hi.iloc[0], []
        starts = runs_of(token)
        mixed = np.minimum.reduceat(label, starts) < np.maximum.reduceat(label, starts)
        for s, t in zip(starts[mixed], np.r_[starts[1:], len(token)][mixed]):
            y = s + np.flatnonzero(own[s:t] == hi)
            for x in np.array_split(s + np.flatnonzero(own[s:t] == lo), -(-(t - s) // 500)):
                total = size[x][:, None] + size[y]
                need = needed(total, percent)
                fit = (label[x][:, None] != label[y]) & (100 * np.minimum(size[x][:, None], size[y]) >= percent * np.maximum(size[x][:, None], size[y])) \
                    & (np.minimum((size - pos)[x][:, None], (size - pos)[y]) >= need)
                i, k = np.nonzero(fit)
                room = (total - 2 * need)[i, k] - bits_apart(bits[x[i]], bits[y[k]])
                ok = room >= 0
                out.append(np.stack([x[i[ok]], y[k[ok]], room[ok]], 1))
        found = np.concatenate([np.empty((0, 3), np.int64), *out]).astype(np.int64)
        a, b = found[:, 0], found[:, 1]
        swap = np.array([cid[i] > cid[k] for i, k in zip(a, b)], bool) if len(found) else np.zeros(0, bool)
        a, b = np.where(swap, b, a), np.where(swap, a, b)
        pairs = pd.DataFrame({"a": cid[a], "b": cid[b], "la": [min(names[i], names[k]) for i, k in zip(a, b)],
                              "lb": [max(names[i], names[k]) for i, k in zip(a, b)], "room": found[:, 2]})
        if best:
            pairs = pairs.sort_values(["room", "a", "b"], ascending=[False, True, True]).drop_duplicates(["la", "lb"])
        return pairs.drop_duplicates(["a", "b"])

    found = rows.groupBy("part", "lo", "hi").applyInPandas(block, "a binary, b binary, la binary, lb binary, room long")
    if best:
        found = found.groupBy("la", "lb").agg(F.max_by(F.struct("a", "b", "room"), "room").alias("p")).select("p.*")
    return sketch_filter(found.select("a", "b", "room").distinct(), classes, percent).select("a", "b")


def class_table(signed: DataFrame) -> DataFrame:
    """One row per distinct set: size, group, prefix, bitmap, smallest doc_id and the key of one of its rows."""
    return signed.where("size > 0").groupBy("cid").agg(
        F.first("size").alias("size"), F.first("gid").alias("gid"), F.first("prefix").alias("prefix"), F.first("bits").alias("bits"), F.first("sketch").alias("sketch"),
        F.min("doc_id").alias("doc_id"), F.min(F.struct("row_key", "text_key")).alias("row"))


def group_runs(classes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Groups of several classes: (gid, gid) pairs of short ones, and long ones as runs of their own."""
    several = classes.groupBy("gid").agg(F.count("*").alias("length")).where("length > 1")
    short = several.where(F.col("length") <= RUN).select(F.col("gid").alias("a"), F.col("gid").alias("b"))
    return short, several.where(F.col("length") > RUN).select(F.col("gid").alias("a"), F.col("gid").alias("token"), F.lit(0).cast("long").alias("pos"), "length")


def find_links(texts: DataFrame, classes: DataFrame, n: int, percent: int) -> DataFrame:
    """(a, b) links between classes, enough of them that components are those of all links."""
    groups = classes.groupBy("gid", "size").agg(F.first("prefix").alias("prefix"))
    ranges = RANGES * texts.rdd.getNumPartitions()
    found = stored(run_pairs(entries(groups, ranges), percent), "ngram_runs")
    own_short, own_long = group_runs(classes)
    members = found.where("token IS NOT NULL").select("a", "part", "token", "pos", "length").unionByName(own_long.withColumn("part", F.expr(f"CAST(pmod(token, {ranges}) AS INT)")))
    slim = classes.drop("prefix")
    candidates = stored(sketch_filter(expand(found.where("token IS NULL AND a <> b").select("a", "b").union(own_short), slim, percent), slim, percent), "ngram_candidates")
    links = verify(nearest_each(candidates), slim, texts, n, percent)
    for best in (True, False):
        labels = connected_components(links)
        more = apart(candidates, labels, best)
        if not members.isEmpty():
            more = more.union(left_over(members, slim, labels, percent, best)).distinct()
        links = stored(links.union(verify(more, slim, texts, n, percent)), "ngram_links")
    discard(found, candidates)
    return links


def ngram_jaccard_join(docs: DataFrame, n: int = 4, percent: int = 85) -> DataFrame:
    """doc_id, n_shingles, component_id and the 64-bit hash of the text per document."""
    texts = id_and_text(docs).withColumn("text_key", F.xxhash64("text"))
    texts = texts.withColumn("row_key", F.coalesce("doc_id", F.xxhash64(F.lit(1), "text")))
    signed = stored(signatures(texts, ngram_levels(texts, n), n, percent), "ngram_signed")
    classes = stored(class_table(signed), "ngram_classes")
    links = find_links(texts, classes, n, percent)
    labels = connected_components(links)
    named = classes.join(labels.withColumnRenamed("node", "cid"), "cid", "left").withColumn("label", F.coalesce("label", "cid"))
    least = named.groupBy("label").agg(F.min("doc_id").alias("component_id"))
    of_class = named.join(least, "label").select("cid", "component_id")
    return signed.join(of_class, "cid", "left").select(
        "doc_id", F.col("size").alias("n_shingles"), F.when(F.col("size") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"), "text_key")
