import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from blocklot.session import get_session, scratch_dir
    session = get_session(master="local[*]", shuffle_partitions=8, app_name="blocklot-tests")
    scratch_dir(session)
    yield session


@pytest.fixture(scope="session")
def sf_dir():
    return SF_SMALL
