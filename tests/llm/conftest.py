import os

import pytest

from galley.llm.common import ship

TINY, SMALL = "/root/testdata/sf0.001", os.environ.get("GALLEY_SF_DIR", "/root/testdata/sf0.01")


@pytest.fixture(scope="session")
def small():
    return SMALL


@pytest.fixture(scope="session")
def documents(spark):
    """The smallest table of documents, with rows at the edges: nulls, blanks, repeats, ties."""
    ship(spark)
    return spark.read.parquet(f"{TINY}/documents.parquet")


@pytest.fixture(scope="session")
def edges(spark):
    """Null and empty texts, a null id, repeated rows, a very long text, and columns with clashing names."""
    ship(spark)
    copied = " ".join(f"word{i}" for i in range(120))
    rows = [
        (1, copied, "en", "x", 1),
        (2, copied, "en", "x", 1),
        (2, copied, "en", "x", 1),
        (3, None, None, "x", 1),
        (4, "", "en", None, None),
        (5, "   \n\t ", "en", "x", 1),
        (6, "a", "en", "x", 1),
        (7, "1234 !!! ...", "fr", "x", 1),
        (8, "A B c", "fr", "x", 1),
        (9, "a b C", "fr", "x", 1),
        (10, "long " + copied.replace("word7 ", "other ") * 300, "en", "x", 1),
        (11, "x" * 50_000, "en", "x", 1),
        (None, copied + " more", "en", "x", 1),
        (12, "İstanbul ΟΔΟΣ <|endoftext|> 日本語 😀 ﬁ ½ it's", "de", "x", 1),
    ]
    names = "doc_id long, text string, lang string, score string, ids int"
    return spark.createDataFrame(rows, names)


@pytest.fixture(scope="session")
def no_documents(spark, edges):
    return edges.where("false")
