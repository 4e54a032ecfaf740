import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, ROOT)

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from tablecare.session import local_session

    return local_session("4", shuffle_partitions=4, app="llm-tests",
                         shared=str(tmp_path_factory.mktemp("shared")))


@pytest.fixture(scope="session")
def awkward(spark):
    """NULLs, empty and long texts, ties, repeated rows, and columns named like results."""
    long = " ".join(f"w{i % 977}" for i in range(30_000))
    rows = [(1, "a b c d e f"), (2, "a b c d e f"), (2, "a b c d e f"), (3, None), (4, ""),
            (None, "a b c d e f"), (None, None), (5, long), (6, long + " x"), (7, "A  b\tC\nd e f"),
            (8, "  "), (9, "one"), (10, "é ß 日本 \u0001\u0002 x")]
    return spark.createDataFrame([(i, t, "keep", 1, 2.0) for i, t in rows],
                                 "doc_id long, text string, kept string, n long, score double")


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], "doc_id long, text string, kept string, n long, score double")
