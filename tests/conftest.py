import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from recado.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session(4, shuffle_partitions=4, **{
        "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")), "spark.driver.memory": "4g"})
    yield session
    session.stop()


@pytest.fixture
def rows():
    """A frame as a sorted list of plain tuples."""
    return lambda df: sorted((tuple(r) for r in df.collect()), key=repr)
