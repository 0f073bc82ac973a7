import os

import pytest
from pyspark.sql import functions as F

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
#: Names that the operators use inside; a table may hold them.
CLASHES = ["h", "fp", "node", "row", "key", "n", "size", "shard", "block", "body", "count", "component_id", "w", "hits", "words", "bucket", "rank",
           "score", "stratum", "id", "vec", "dim", "tab", "cell", "host", "template", "t", "copies", "kept", "held_out"]


@pytest.fixture(scope="session")
def sf():
    return "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in every column, empty and long texts, copies, ties, repeated rows, and columns with the operators' own names."""
    long_text = " ".join(f"word{i % 977} and{i % 13}" for i in range(40_000))
    passage = "a passage of words that goes on for well over fifty bytes in a row, and more"
    rows = [(1, f"first {passage} one", "en", "a", 1), (2, f"second {passage} two", "en", "b", 1), (2, f"second {passage} two", "en", "b", 1),
            (3, None, None, None, None), (4, "", "de", "a", 0), (5, long_text, "en", "c", 5), (6, long_text + " tail", "en", "c", 5),
            (None, f"null id {passage}", "en", None, 2), (None, None, None, None, None), (7, " \n\t ", "fr", "d", 3), (8, "...!!", "fr", "d", 3),
            (9, "é" * 60 + "ß", "fr", "d", 3), (10, "é" * 60 + "ñ", "fr", "d", 3), (-4, f"minus {passage}", "en", "a", 1), (11, "one", "en", "a", 1)]
    docs = spark.createDataFrame(rows, DOCS)
    return docs.select("*", *[F.lit(i).alias(c) for i, c in enumerate(CLASHES)])


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)


def documents(spark, sf):
    return spark.read.parquet(os.path.join(sf, "documents.parquet"))
