import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from routeledger.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session("4", "tests")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def rows():
    """Collect a frame as a sorted list of tuples over the named columns."""
    def collect(df, *columns):
        got = df.select(*columns) if columns else df
        return sorted((tuple(r) for r in got.collect()), key=repr)
    return collect
