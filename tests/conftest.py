import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from tidemart.session import build_session, checkpoint_dir
    from tidemart.streaming.jobs import enable_state_store

    s = build_session("local[4]", shuffle_partitions=8, app="tidemart-tests")
    enable_state_store(s)
    checkpoint_dir(s)
    yield s
    s.stop()


@pytest.fixture()
def scratch():
    return tempfile.mkdtemp(prefix="tidemart-test-", dir="/tmp")


SF_SMALL = "/root/testdata/sf0.001"
