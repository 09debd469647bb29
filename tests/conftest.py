import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from unifeed.session import local_session
    s = local_session("*", shuffle_partitions=8, app="unifeed-tests")
    yield s
    s.stop()


def rows_of(df, *cols):
    """Collect small test frames as tuples (test helper only)."""
    return [tuple(r[c] for c in cols) if cols else tuple(r) for r in df.collect()]
