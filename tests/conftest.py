import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from siltstone.session import get_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = get_session("tests", "local[4]", spark__sql__shuffle__partitions="4", spark__driver__memory="4g")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def work(tmp_path):
    return str(tmp_path)


def rows(df):
    """The rows as sorted tuples, NULLs first."""
    return sorted((tuple(r) for r in df.collect()), key=lambda r: [(v is not None, str(v)) for v in r])
