import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from skydrift.session import build_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    s = build_session("local[*]", app="skydrift-tests", shuffle_partitions=8)
    s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="skydrift-test-ckpt-"))
    yield s
    s.stop()
