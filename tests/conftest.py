import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from ledgerlake.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = build_session(master="local[*]", shuffle_partitions=8, app="ledgerlake-tests",
                      extra={"spark.checkpoint.dir": tempfile.mkdtemp(prefix="ledgerlake-test-ckpt-")})
    yield s
    s.stop()


SMOKE = "/root/testdata/sf0.001"
