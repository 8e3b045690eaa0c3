import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from comms_lake.session import build_session
    s = build_session(master="local[4]", shuffle_partitions=4, app="comms_lake_tests")
    yield s
    s.stop()


def one(df, col):
    rows = df.select(col).collect()
    assert len(rows) == 1
    return rows[0][0]
