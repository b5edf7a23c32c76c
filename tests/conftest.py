import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SMALL = "/root/testdata/sf0.001"
MEDIUM = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from quarry.session import local_session

    s = local_session(cores="*", shuffle_partitions=8, app="quarry-tests")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def duck_small():
    from quarry.oracle.check import duck

    return duck(SMALL)


@pytest.fixture(scope="session")
def duck_medium():
    from quarry.oracle.check import duck

    return duck(MEDIUM)
