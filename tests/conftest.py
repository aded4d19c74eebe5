import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from ratesmith.session import build_session

    s = build_session("local[4]", shuffle_partitions=4, app_name="ratesmith-tests")
    s.sparkContext.setLogLevel("ERROR")
    yield s


@pytest.fixture()
def scratch():
    """A new folder per test (never reused, never emptied)."""
    return tempfile.mkdtemp(prefix="ratesmith-test-")


def rows(df, *cols):
    """Sorted list of tuples (selected columns, or all)."""
    sel = df.select(*cols) if cols else df
    return sorted((tuple(r) for r in sel.collect()), key=lambda r: tuple((x is None, str(x)) for x in r))
