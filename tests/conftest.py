import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from quillmill.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session("tests", "4", shuffle_partitions=4)
    yield session
    session.stop()


@pytest.fixture(scope="session")
def rows():
    """Sorted plain tuples of a DataFrame."""
    return lambda df: sorted((tuple(r) for r in df.collect()), key=repr)
