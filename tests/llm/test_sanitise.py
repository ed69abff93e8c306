import hashlib
import math
import re
from collections import Counter, defaultdict

import xxhash
from pyspark.sql import functions as F

from billow.llm import sanitise as s

STATED = {
    "email": re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    "ip": re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    "card": re.compile(r"[0-9]([\x20-]?[0-9])+"),
    "phone": re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
}


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (2 if i % 2 else 1)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def ok(kind, m):
    digits = re.sub("[^0-9]", "", m)
    return {"email": True, "ip": kind == "ip" and all(int(p) <= 255 for p in m.split(".")), "card": 12 <= len(digits) <= 19 and luhn(digits), "phone": 9 <= len(digits) <= 15}[kind]


def brute(text):
    text = text or ""
    spans = sorted((m.start(), list(STATED).index(k), m.end(), m.group()) for k, p in STATED.items() for m in p.finditer(text) if ok(k, m.group()))
    told = ",".join(f"{list(STATED)[k]}:{a}:{b}" for a, k, b, _ in spans)
    return (*[sum(k == i for _, k, _, _ in spans) for i in range(4)], hashlib.sha256(told.encode()).hexdigest(), told)


def run(df, **more):
    return Counter((r.doc_id, r.n_email, r.n_ip, r.n_card, r.n_phone, r.base_sha256, r.spans) for r in s.find_personal_data(df, **more).collect())


HARD = ["a@b.c+d@e.f", "a@b.c_d@e.f", "x@y", "a@b.c..d@e.f", "@a.b", "a@b@c.d", "1.2.3.4.5.6.7.8", "256.1.1.1 1.1.1.256", "0000255.1.2.3", "1.2.3", "4111 1111 1111 1111",
        "4111-1111-1111-1111 2", "5 4111111111111111", "4111  1111 1111 1111", "411111111111111", "+1 (017) 555-7713", "+1+12345678901", "+1 2", "++4 (99) 123.456.78-", "é😀 a@b.co 1.1.1.1\n+49 30 1234567",
        "1" * 4000, "1 " * 4000, "a" * 2000, "a." * 3000 + "@", "1." * 3000, "+" * 3000, "a@b.c " * 900, "1.2.3.4 " * 700, "4111111111111111  " * 600, "a@" + "b." * 2000 + "c"]


def test_documents_and_hard_texts(spark, docs, odd):
    hard = spark.createDataFrame(list(enumerate(HARD)), "doc_id long, text string")
    for df in (docs, odd, hard):
        assert run(df) == Counter((r.doc_id, *brute(r.text)) for r in df.collect())


def test_long_runs_take_linear_time(spark):
    texts = ["a" * 400_000, "1" * 400_000, "1 " * 200_000, "a." * 200_000, "1." * 200_000, "+" * 400_000]
    out = s.find_personal_data(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    assert [r.spans for r in out] == [""] * 6 or sum(r.n_ip for r in out) == sum(r.n_ip > 0 for r in out) * 50_000


def test_empty_table(none):
    out = s.find_personal_data(none)
    assert out.columns[:7] == ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"] and out.count() == 0


def corpus():
    rows = []
    for i in range(400):
        lines = [f"plain words number{i} with the usual the"]
        if i % 40 == 0:
            lines.append(f"Write to bob@x.org about Zanzibar, {i}th note, the")
        if i % 50 == 1:
            lines.append(f"zanzibar! once more in {i}")
        if i % 40 == 2:
            lines.append(f"call +1 (017) 555-7713 the café-owner no{i}")
        rows.append((i, "\n".join(lines)))
    rows += [(1000 + i, "copied line hapax ann@y.net") for i in range(50)]
    return rows


def views(kind, value):
    digits = re.sub("[^0-9]", "", value)
    shared = {"email": value.split("@")[-1].lower(), "ip": ".".join(value.split(".")[:2]), "card": digits[:6], "phone": digits[:4]}[kind]
    return {("value", kind, value.lower()), ("view", kind, shared), ("kind", kind), ("any",)}


def words_of(text):
    return {w for w in (re.sub(r"^[\W_]+|[\W_]+$", "", x) for x in text.lower().split()) if re.search(r"[^\W\d_]", w) and "@" not in w}


def brute_terms(rows, alpha=s.ALPHA, support=s.SUPPORT):
    texts = {t or "" for _, t in rows}
    of_term, of_entity, both, lines = Counter(), Counter(), Counter(), defaultdict(set)
    for text in texts:
        entities = set().union(*[views(k, m.group()) for k, p in STATED.items() for m in p.finditer(text) if ok(k, m.group())])
        of_term.update(words_of(text))
        of_entity.update(entities)
        for e in entities:
            for w in words_of(text):
                both[e, w] += 1
            first = {}
            for line in text.split("\n"):
                h = xxhash.xxh64_intdigest(line, 42)
                h -= (h >> 63) << 64
                for w in words_of(line):
                    first[w] = min(h, first.get(w, h))
            for w, h in first.items():
                lines[e, w].add(h)
    n = len(texts)
    return {w for (e, w), c in both.items() if c >= support and len(lines[e, w]) > 1 and of_entity[e] < n
            and math.log2(n * c / (of_term[w] + s.PRIOR) / of_entity[e]) >= alpha * -math.log2(of_entity[e] / n)}


def test_given_documents_have_disclosing_terms(spark):
    """Terms are found on the given table, the ones that brute force finds, and clean documents stay as they are."""
    df = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    found = {r.term for r in s.disclosing_terms(df).collect()}
    assert found and found == brute_terms([(r.doc_id, r.text) for r in df.collect()])
    out = s.find_personal_data(df).collect()
    private = [r for r in out if r.n_email + r.n_ip + r.n_card + r.n_phone]
    assert sum(r.n_term > 0 for r in private) > 0 and sum(r.n_term > 0 for r in out) - sum(r.n_term > 0 for r in private) <= 0.01 * len(out)
    print(sorted(found), len(private), sum(r.n_term > 0 for r in private), sum(r.n_term > 0 for r in out))


def test_terms_equal_brute_force(spark):
    rows = corpus()
    df = spark.createDataFrame(rows, "doc_id long, text string")
    want = brute_terms(rows)
    assert {"zanzibar", "write", "café-owner"} <= want and "the" not in want and "hapax" not in want
    assert {r.term for r in s.disclosing_terms(df).collect()} == want
    out = {r.doc_id: r for r in s.find_personal_data(df).collect()}
    for i, text in rows:
        found = [text[int(x.split(":")[1]):int(x.split(":")[2])].lower() for x in out[i].spans.split(",") if x.startswith("term")]
        free = text
        for p in STATED.values():
            free = p.sub(lambda m: " " * len(m.group()), free)
        assert Counter(found) == Counter(re.sub(r"^\W+|\W+$", "", w) for w in free.lower().split() if re.sub(r"^\W+|\W+$", "", w) in want)
        assert out[i].n_term == len(found)


def test_sanitised_text(spark):
    df = spark.createDataFrame(corpus(), "doc_id long, text string")
    general = spark.createDataFrame([("Zanzibar", "an island"), ("café-owner", "write"), ("write", None)], "term string, general string")
    out = {r.doc_id: r.text for r in s.sanitise(df, general).collect()}
    assert out[40].split("\n")[1].startswith(" ") and "[EMAIL]" in out[40] and "an island, 40th" in out[40] and "bob" not in out[40]
    assert out[1].split("\n")[1] == "an island! once more in 1"
    assert "[PHONE]" in out[2] and "caf" not in out[2] and out[3] == corpus()[3][1]
    assert {r.text for r in s.sanitise(df.limit(0)).collect()} == set()


def test_main_path_is_native(docs):
    plan = s.base_spans(docs.select("doc_id", F.col("text")))._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
