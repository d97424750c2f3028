import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    from granero.session import local_session

    session = local_session(os.environ.get("TEST_CPUS", "8"), shuffle_partitions=4)
    yield session
    session.stop()


@pytest.fixture(scope="session")
def folder():
    return FOLDER
