import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from scorewright.session import local_session

    folder = tempfile.mkdtemp(prefix="scorewright-checkpoints-")
    session = local_session("scorewright-tests", cores="*", shuffle_partitions=8, extra={"spark.checkpoint.dir": folder})
    yield session
    session.stop()


@pytest.fixture()
def scratch():
    """A fresh folder for one test (never reused, never cleared)."""
    return tempfile.mkdtemp(prefix="scorewright-test-")
