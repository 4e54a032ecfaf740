import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from tablecare.session import local_session

    yield local_session("4", shuffle_partitions=8, app="tablecare-tests",
                        shared=str(tmp_path_factory.mktemp("shared")))


def rows(df, cols=None):
    """Rows as sorted tuples (order-insensitive comparison)."""
    cols = cols or df.columns
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr)
