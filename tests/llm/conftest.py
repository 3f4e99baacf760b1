import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

#: Edge cases every operator must take: nulls in any column, empty and white
#: texts, very long texts, ties, repeated rows, clashing extra columns.
EDGE_ROWS = [
    (1, "One plain line of words here.\nAnother line follows it.\nAnd a third one ends.", "en", "a", 70, "x", 1),
    (2, None, "en", "a", None, None, None),
    (None, "One plain line of words here.\nAnother line follows it.\nAnd a third one ends.", None, None, None, "y", 2),
    (3, "", "de", "b", 0, "z", 3),
    (4, " \t\n \n", "de", None, 5, "z", 3),
    (5, "Word " * 60000, "en", "b", 300000, "z", 3),
    (6, "x" * 200000, "fr", "b", 200000, "z", 3),
    (7, "ONE PLAIN LINE of words here.\nAnother line follows it.\nAnd a third one ends.", "en", "a", 70, "x", 1),
    (7, "ONE PLAIN LINE of words here.\nAnother line follows it.\nAnd a third one ends.", "en", "a", 70, "x", 1),
    (8, "123 456 !!! 😀 ñandú \x00 ▁ end", "es", "c", 20, "x", 1),
]
EDGE_SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, "
               "spans string, kept int")


@pytest.fixture
def edge(spark):
    return spark.createDataFrame(EDGE_ROWS, EDGE_SCHEMA)


@pytest.fixture
def nothing(spark):
    return spark.createDataFrame([], EDGE_SCHEMA)


@pytest.fixture(scope="session")
def small():
    return "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def llm_queries():
    from sessionlake.llm import queries
    return queries.queries()


@pytest.fixture(scope="session")
def small_docs(spark, small):
    return [tuple(r) for r in spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect()]
