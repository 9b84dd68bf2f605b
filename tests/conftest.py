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
    from reelspark.session import build_session, checkpoint_dir
    s = build_session("local[4]", app="reelspark-tests", shuffle_partitions=8)
    # tests only: the cluster names spark.checkpoint.dir; here it is unset
    checkpoint_dir(s, tempfile.mkdtemp(prefix="reelspark-test-ckpt-", dir="/tmp"))
    yield s
    s.stop()


@pytest.fixture()
def tmp_base():
    return tempfile.mkdtemp(prefix="reelspark-test-", dir="/tmp")
