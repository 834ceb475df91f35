import os
import sys

import pytest

sys.path[:0] = [os.path.dirname(os.path.abspath(__file__)), os.path.dirname(os.path.dirname(os.path.abspath(__file__)))]

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"
LONG = " ".join(f"word{i % 997}x" for i in range(30_000))


@pytest.fixture(scope="session")
def edge_rows():
    """Nulls in every column, empty and very long texts, repeated rows, equal ids, odd characters."""
    return [
        (1, "Released under the MIT License. See the general public license.", "en", "a", 10),
        (1, "Released under the MIT License. See the general public license.", "en", "a", 10),
        (2, None, None, None, None),
        (3, "", "en", "a", 0),
        (4, LONG, "en", None, None),
        (None, "a row without an id, of some words", "en", "a", 3),
        (None, None, None, None, None),
        (5, " \n\t ", "fr", "b", 4),
        (6, "ünïcode Ωmega 中文 text <|endoftext|> K İ \x00\x1c", "de", "b", 5),
        (7, "123 456 %%% ###", None, "b", 6),
        (8, "one", "es", "b", 3),
        (8, "another text under the same id", "es", "b", 3),
    ]


@pytest.fixture(scope="session")
def edge_docs(spark, edge_rows):
    """The rows above with columns whose names the operators use themselves."""
    df = spark.createDataFrame(edge_rows, DOCUMENTS).repartition(3)
    return df.selectExpr("*", *(f"1 AS {c}" for c in CLASHING))


CLASHING = ["row", "n", "class", "hash", "score", "shard", "slot", "at", "ids", "region", "words", "label", "held_out"]


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCUMENTS)
