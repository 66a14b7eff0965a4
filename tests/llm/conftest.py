import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
os.environ["PYTHONPATH"] = ROOT + os.pathsep + os.environ.get("PYTHONPATH", "")  # for Python workers
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))  # tests share their brute-force versions

LONG = "la casa und the " * 4000
#: id, text: null and empty texts, null ids, repeated rows, ties, a very long text
TEXTS = [
    (1, "the quick brown fox jumps over the lazy dog near the old river bank today"),
    (2, "The quick brown fox jumps over the lazy dog near the old river bank today"),
    (3, "the quick brown fox jumps over the lazy dog near the old river bank tonight"),
    (4, "one two"),
    (5, "ONE\ttwo"),
    (6, None),
    (7, ""),
    (8, " \n\t "),
    (9, LONG),
    (10, LONG + "end"),
    (None, "one two"),
    (None, None),
    (11, "12345 !!! ???"),
    (11, "12345 !!! ???"),
    (12, "a completely different sentence about nothing much that nobody wrote before now"),
]


@pytest.fixture()
def texts(spark):
    """With columns whose names an operator might use itself."""
    rows = [(i, t, "x", i or 0, "en" if (i or 0) % 2 else "fr") for i, t in TEXTS]
    return spark.createDataFrame(rows, "doc_id long, text string, id string, n long, lang string").repartition(3)


@pytest.fixture()
def no_texts(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string")
