import random

import pytest

from slotstream.llm.tables import read

SF = "/root/testdata/sf0.001"

EDGES = [
    (1, None),
    (2, ""),
    (3, "one"),
    (4, "one"),
    (4, "one"),
    (None, "a row without an id"),
    (5, " \n\t  "),
    (6, "Ünïcode 你好 мир \U0001f600 é   x"),
    (7, "one two\n\nthree  four\r\nfive"),
]


@pytest.fixture(scope="session")
def documents(spark):
    """A documents table from (doc_id, text) pairs; several columns have names that operators use
    for columns of their own."""

    def make(*pairs, lang="en"):
        rows = [(i, t, lang, "src", len(t or ""), 1, "x", 2, "y") for i, t in pairs]
        return spark.createDataFrame(
            rows,
            "doc_id long, text string, lang string, source string, n_chars long, "
            "length int, node string, shard int, content string",
        )

    return make


@pytest.fixture(scope="session")
def edges(documents):
    """NULLs, empty and odd texts, repeated rows, and a very long text."""
    draw = random.Random(1)
    words = [f"w{i}" for i in range(5000)]
    return documents(*EDGES, (8, " ".join(draw.choice(words) for _ in range(120_000))))


@pytest.fixture(scope="session")
def none(documents):
    return documents((1, "x")).limit(0)


@pytest.fixture(scope="session")
def small(spark):
    return read(spark, SF, "documents")


@pytest.fixture(scope="session")
def texts(small):
    return {r.doc_id: r.text or "" for r in small.select("doc_id", "text").collect()}
