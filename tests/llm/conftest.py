from __future__ import annotations

import random

import pytest

SF = "/root/testdata/sf0.001"
#: Names that operators use inside; a table may have such columns too.
CLASHING = ("id", "h", "n", "token", "kept", "score", "spans", "rate", "n_tokens", "posterior", "_key", "_first",
            "_bad", "removed", "cid", "word.s")


def prose(seed: int, n: int, vocabulary: int = 400) -> str:
    rnd = random.Random(seed)
    return " ".join(f"w{rnd.randrange(vocabulary)}" for _ in range(n)) + "."


@pytest.fixture(scope="session")
def edge_rows():
    """NULLs, empty and very long texts, copies, near copies, repeated rows."""
    base = prose(1, 120, 10**6)
    long = "\n".join(prose(i, 40, 5000) for i in range(3000))
    texts = {1: base, 2: base, 3: base.replace(" w", " v", 1), 4: None, 5: "", 6: " \t\n ", 7: "one", 8: "One two",
             9: "one two", 10: long, 11: prose(2, 60), 12: "Ünï çödé ſ K 漢字 " * 12, 13: "\n\n" + base + "\n",
             14: "!!! ??? ...", 15: "same line here now\n" * 6}
    rows = [(k, t, "en", "src", len(t) if t is not None else None) for k, t in texts.items()]
    return rows + [rows[0], rows[3], (None, prose(3, 50), None, None, None), (None, None, None, None, None)]


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def edge_docs(spark, edge_rows):
    return spark.createDataFrame(edge_rows, SCHEMA)


@pytest.fixture(scope="session")
def clashing_docs(edge_docs):
    from pyspark.sql import functions as F
    return edge_docs.select("*", *[F.lit(1).alias(c) for c in CLASHING])


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def sf_docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="session")
def sf_texts(sf_docs):
    return {r.doc_id: r.text for r in sf_docs.collect()}
