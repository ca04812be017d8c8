import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from matchweave.session import local_session

from tests import golden


@pytest.fixture(scope="session")
def spark():
    session = local_session("tests", os.environ.get("TEST_CPUS", "8"))
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def season(spark):
    """The 50 golden matches as clean matches of one competition."""
    return golden.matches(spark)
