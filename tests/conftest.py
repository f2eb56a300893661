import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from chainlens.session import get_spark

    s = get_spark("local[4]", 4)
    yield s
    s.stop()


def rows(df, cols=None):
    """Sorted list of tuples (order-insensitive comparison helper)."""
    cols = cols or df.columns
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr)
