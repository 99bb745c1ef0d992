import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from quill.session import local_session
    s = local_session(4, shuffle_partitions=8, app="quill-tests")
    yield s
    s.stop()


def rows(df, *cols):
    """Collected rows as sorted tuples (optionally of selected columns)."""
    if cols:
        df = df.select(*cols)
    return sorted(tuple(r) for r in df.collect())
