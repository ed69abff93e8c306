"""Token counts with a whole-token shortcut.

A byte-level BPE tokenizer splits a text into pre-tokens and merges each one on
its own, so a text's token count is a sum over its pre-tokens.  Offline (once
per Python worker) every vocabulary string is merged alone; those that come
back as one token are proven *whole*.  A pre-token equal to a whole string
counts one without merging; only the rest is merged, and remembered in a table
of bounded size (forgetting costs time, never a different count).

Defined results: null text counts as empty (0 bytes, 0 tokens); special strings
of the tokenizer file that stand in a text are one token each, as the library
does by default; rows stay one to one with the input, repeated rows included.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from billow.llm.common import id_and_text

#: Remembered counts of merged pre-tokens per Python worker.
MEMO_ENTRIES = 1_000_000
#: Texts longer than this are walked match by match instead of as one list.
LIST_CHARS = 2_000_000
# The byte-level pre-token pattern and the bytes that stand for themselves.
PRE_TOKEN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
PRINTABLE = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]


def byte_letters() -> dict[int, str]:
    """Latin-1 code point of each byte -> the letter that the vocabulary writes for it."""
    letters = {b: chr(b) for b in PRINTABLE}
    hidden = [b for b in range(256) if b not in letters]
    return letters | {b: chr(256 + i) for i, b in enumerate(hidden)}


class PieceCounts(dict):
    """pre-token -> number of tokens; whole strings are there from the start."""

    def __init__(self, tokenizer) -> None:
        super().__init__()
        self._merge = tokenizer.model.tokenize
        self._letters = byte_letters()
        back = {ord(c): b for b, c in self._letters.items()}
        for string in tokenizer.get_vocab(with_added_tokens=False):
            raw = bytes(back[ord(c)] for c in string if ord(c) in back)
            try:
                piece = raw.decode("utf-8")
            except UnicodeDecodeError:
                continue
            if len(raw) == len(string) and len(self._merge(string)) == 1:
                self[piece] = 1
        self.whole = dict(self)

    def __missing__(self, piece: str) -> int:
        n = len(self._merge(piece.encode("utf-8").decode("latin-1").translate(self._letters)))
        if len(self) >= MEMO_ENTRIES + len(self.whole):
            self.clear()
            self.update(self.whole)
        self[piece] = n
        return n


@lru_cache(maxsize=2)
def counter(path: str):
    """text -> number of tokens, for the tokenizer file at ``path``."""
    import regex
    from tokenizers import Tokenizer

    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    pre = spec["pre_tokenizer"]
    if spec["normalizer"] or spec["model"]["type"] != "BPE" or pre["type"] != "ByteLevel" or pre["add_prefix_space"]:
        raise ValueError(f"not a plain byte-level BPE tokenizer: {path}")
    pieces = PieceCounts(Tokenizer.from_file(path))
    pattern = regex.compile(PRE_TOKEN)
    specials = [t["content"] for t in spec["added_tokens"]]
    special = regex.compile("|".join(map(regex.escape, sorted(specials, key=len, reverse=True)))) if specials else None

    def run(part: str) -> int:
        if len(part) <= LIST_CHARS:
            return sum(map(pieces.__getitem__, pattern.findall(part)))
        return sum(pieces[m.group()] for m in pattern.finditer(part))

    def count(text: str) -> int:
        if special is None or not special.search(text):
            return run(text)
        parts = special.split(text)
        return len(parts) - 1 + sum(map(run, parts))

    return count


def token_counts(docs: DataFrame, tokenizer_path: str, limit: int = 512) -> DataFrame:
    """doc_id, n_bytes (UTF-8), n_tokens and over_limit (more than ``limit`` tokens) per document."""

    @F.pandas_udf("long")
    def n_tokens(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        count = counter(tokenizer_path)
        for batch in texts:
            yield batch.map(count)

    d = id_and_text(docs)
    return (d.select("doc_id", F.octet_length("text").cast("long").alias("n_bytes"), n_tokens("text").alias("n_tokens"))
            .withColumn("over_limit", F.col("n_tokens") > limit))
