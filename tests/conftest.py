import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from martwright.session import build_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    ckpt = tempfile.mkdtemp(prefix="martwright-test-ckpt-")
    s = build_session(
        master="local[*]",
        app_name="martwright-tests",
        shuffle_partitions=8,
        extra_conf={"spark.checkpoint.dir": ckpt},
    )
    yield s
    s.stop()


@pytest.fixture()
def tmp_out():
    return tempfile.mkdtemp(prefix="martwright-test-out-")
