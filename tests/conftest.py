import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tests")]

DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    from opinara.session import local_session

    session = local_session("opinara-tests", cores="4", memory="6g", shuffle_partitions=4)
    yield session
    session.stop()


@pytest.fixture(scope="session")
def data():
    return DATA
