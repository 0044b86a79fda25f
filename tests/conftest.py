import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from gapscope.session import local_session

    s = local_session(4, shuffle_partitions=8)
    yield s


@pytest.fixture
def scratch(spark):
    from gapscope.session import scratch_path

    return lambda name: scratch_path(spark, name)


def rows(df, *cols):
    """Sorted list of tuples (None sorts first)."""
    cols = cols or tuple(df.columns)
    key = lambda t: tuple((v is not None, v) for v in t)
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=key)
