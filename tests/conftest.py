import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from ordstar.session import build_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    s = build_session(master=os.environ.get("TEST_MASTER", "local[*]"), shuffle_partitions=8)
    yield s
    s.stop()


def rows(df, *cols):
    return [tuple(r[c] for c in cols) for r in df.collect()]
