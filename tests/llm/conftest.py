from __future__ import annotations

import random

import pytest

SF = "/root/testdata/sf0.001"
KINDS = "doc_id long, text string, lang string, source string, n_chars long"
#: Names that operators use for outputs and inner columns.
CLASHES = ("score", "n_words", "batch", "component_id", "block", "part", "text_id", "h", "label", "kept", "spans", "tail", "bucket_len", "node", "key")


def prose(seed: int, words: int) -> str:
    pick = random.Random(seed)
    return " ".join("".join(pick.choice(("ta", "re", "lo", "mi", "na", "the", "of")) for _ in range(pick.randint(1, 4))) for _ in range(words))


@pytest.fixture(scope="session")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="session")
def rows(docs):
    return [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls, empty, blank and very long texts, ties, near copies; ids are unique."""
    base = prose(1, 300)
    long = prose(2, 30_000)
    texts = [None, "", " \t\n ", "one", "one two three", "One TWO three", base, base, base.replace("ta", "TA"), base + " end of it", long, long + " more"]
    texts += ["x" * 5000, "ab" * 400, "é" * 300, "é" * 299 + "è", "\x00 \x1f null bytes \x00", "日本語 テキスト", "password = abcdefghijkl!", "12345 67890 +-*/"]
    return [(i * 3, t, "en" if i % 2 else None, None if i % 3 else "s", None) for i, t in enumerate(texts)]


@pytest.fixture(scope="session")
def odd(spark, odd_rows):
    """Those rows with clashing extra columns."""
    df = spark.createDataFrame(odd_rows, KINDS)
    return df.selectExpr("*", *[f"cast({k} as string) as {c}" for k, c in enumerate(CLASHES)])


@pytest.fixture(scope="session")
def repeated(spark, odd_rows):
    """The same with every row twice and a few without id."""
    return spark.createDataFrame(odd_rows + odd_rows + [(None, *r[1:]) for r in odd_rows[5:9]], KINDS)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], KINDS)
