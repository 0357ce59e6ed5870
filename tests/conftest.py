import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from lanelux.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session("8", "lanelux-tests")
    yield session
    session.stop()


@pytest.fixture
def rows(spark):
    """Rows of a SELECT, sorted, as tuples."""

    def run(df):
        return sorted((tuple(r) for r in df.collect()), key=lambda r: tuple((v is None, str(v)) for v in r))

    return run
