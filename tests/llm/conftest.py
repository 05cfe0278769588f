import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

SF = "/root/testdata/sf0.001"
LONG = " ".join(f"word{i * i % 977} filler{i % 53}" for i in range(12_000))
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def base_rows():
    """Plain, empty, NULL, repeated, very long and tied rows."""
    plain = "the cat of the house and the dog of the yard is in a garden that was made for it on the hill by the old road " * 1
    rows = [
        (1, plain, "en", "a", 1), (2, plain, "en", "a", 1), (3, "", "en", "a", 0), (4, None, None, None, None), (5, "one", "fr", "b", 3),
        (6, "line one is here\nline one is here\n\nline one is here\n", "xx", "b", 1), (7, "#$% " * 60, "en", "c", 240), (8, LONG, "en", "c", len(LONG)),
        (9, LONG + " tail", "de", "c", 1), (10, "le chat de la maison et les chiens " * 8, "fr", None, 1), (11, "éÉ \U0001F600 中文 " * 10, "es", "d", 1),
    ]
    return rows


@pytest.fixture(scope="session")
def edge_docs(spark):
    return spark.createDataFrame(base_rows(), DOCS)


@pytest.fixture(scope="session")
def empty_docs(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="session")
def clashing_docs(spark):
    """Repeated rows, a NULL id, and columns named like helpers and results."""
    from pyspark.sql import functions as F

    rows = base_rows() + [base_rows()[0], (None, "no id but some words in the text of it", "en", "a", 1), (None, None, None, None, None)]
    extra = ["kept", "size", "Taken", "n_words", "words", "plan", "gone", "bad_doc", "bad_key", "r_doc", "r_tag", "tag", "rep", "node", "component", "copies", "key", "doc", "w"]
    return spark.createDataFrame(rows, DOCS).withColumns({c: F.lit(7) for c in extra})
