import public_tokenizers
from tokenizers import Tokenizer

from billow.llm import token_counts

PATH = public_tokenizers.path("byte_bpe_50k.json")


def check(df):
    lib = Tokenizer.from_file(PATH)
    got = sorted((r.doc_id or -1, r.n_bytes, r.n_tokens, r.over_limit) for r in token_counts.token_counts(df, PATH).collect())
    want = []
    for r in df.select("doc_id", "text").collect():
        n = len(lib.encode(r.text or "", add_special_tokens=False).ids)
        want.append((r.doc_id or -1, len((r.text or "").encode()), n, n > 512))
    assert got == sorted(want)


def test_equals_the_library(docs):
    check(docs)


def test_odd_rows(odd):
    check(odd)


def test_empty_table(none):
    out = token_counts.token_counts(none, PATH)
    assert out.columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"] and out.count() == 0


def test_forgetting_changes_nothing(monkeypatch):
    count = token_counts.counter.__wrapped__(PATH)
    monkeypatch.setattr(token_counts, "MEMO_ENTRIES", 3)
    small = token_counts.counter.__wrapped__(PATH)
    text = "the thoreou anti bleblen xyzzy the qwrtp zzz thoreou"
    assert count(text) == small(text)


def test_long_text_walk(monkeypatch):
    count = token_counts.counter.__wrapped__(PATH)
    text = "Haanth.\nReoush  hewh and onon <|endoftext|> x" * 50
    n = count(text)
    monkeypatch.setattr(token_counts, "LIST_CHARS", 5)
    assert count(text) == n
