import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from floe.session import build_session

    ckpt = tempfile.mkdtemp(prefix="floe-test-ckpt-")
    session = build_session(
        "local[8]",
        "floe-tests",
        shuffle_partitions=8,
        extra={"spark.checkpoint.dir": ckpt},
    )
    yield session
    session.stop()
