import random

import pytest

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


ODD_TEXTS = [None, "", " ", "\n\n", "a", "a\n\na", "É x y", "<|endoftext|>", "x<|endoftext|>y  z ",
             "w " * 3000, "long" * 5000, "1 2 3 " * 500, "\x00\x0b\x1c tab\tend", "'s don't WE'LL 12,5% 😀😀 日本語"]


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls in every column, empty and long texts, repeated rows, extra columns with clashing names."""
    rows = [(i, t, None if i % 3 else "en", None if i % 2 else "s", None, "clash", 1.5, True) for i, t in enumerate(ODD_TEXTS)]
    rows += [rows[4], rows[4], (None, "null id here", None, None, None, None, None, None),
             (None, None, None, None, None, None, None, None)]
    random.Random(0).shuffle(rows)
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, "
                                       "n_tokens string, score double, kept boolean")


@pytest.fixture(scope="session")
def none(odd):
    return odd.limit(0)
