import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from barlake.session import build_session
    s = build_session("local[*]", app_name="barlake-tests", shuffle_partitions=8)
    # tests run on one machine: a private checkpoint folder is fine here
    s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="barlake-test-ckpt-"))
    yield s
    s.stop()


@pytest.fixture()
def tmp_lake(tmp_path):
    return str(tmp_path / "lake")
