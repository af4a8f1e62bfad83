import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from graphweave.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    # tests only: a private checkpoint folder (a cluster names a shared one)
    ckpt = tempfile.mkdtemp(prefix="gw-test-ckpt-")
    s = build_session(master="local[4]", shuffle_partitions=8, extra={"spark.checkpoint.dir": ckpt})
    yield s
