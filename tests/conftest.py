import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF0001 = "/root/testdata/sf0.001"
SF001 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from tidewater.session import build_session

    s = build_session("tidewater-tests", master="local[4]", shuffle_partitions=8,
                      checkpoint_dir=tempfile.mkdtemp(prefix="tidewater-tests-"))
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture()
def lake(spark):
    from tidewater.config import LakeConfig
    from tidewater.registry import CLOCK
    from tidewater.sinks.storage import scratch_dir

    return LakeConfig(root=scratch_dir(spark, "test"), clock=CLOCK)
