import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from encore.session import build_session  # noqa: E402
from rows import at  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = build_session(master="local[4]", shuffle_partitions=4, app="encore-tests")
    s.sparkContext.setLogLevel("ERROR")
    yield s


@pytest.fixture
def listens(spark):
    """Listens from (customer, artist) pairs in arrival order, one second apart."""
    def make(pairs, step_seconds=1.0, start=0):
        rows = [(str(start + i), c, a, at(start + i, step_seconds), start + i) for i, (c, a) in enumerate(pairs)]
        return spark.createDataFrame(rows, "id string, customerid string, artistid string, streamtime timestamp, "
                                           "pos bigint")
    return make
