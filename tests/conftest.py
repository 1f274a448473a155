import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from kestrel.session import local_session
    s = local_session("*", shuffle_partitions=8)
    yield s
    s.stop()


def rows(df, *cols):
    """Sorted list of tuples (optionally of the given columns)."""
    d = df.select(*cols) if cols else df
    return sorted((tuple(r) for r in d.collect()),
                  key=lambda t: tuple((x is not None, x if x is not None else 0) for x in t))
