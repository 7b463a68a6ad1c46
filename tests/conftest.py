import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from chartgrid.session import build_session
    s = build_session("local[4]", 8, app="chartgrid-tests")
    # tests only: a private checkpoint folder when the cluster setting is absent
    if not s.conf.get("spark.checkpoint.dir", None):
        s.conf.set("spark.checkpoint.dir", tempfile.mkdtemp(prefix="chartgrid-test-ckpt-"))
    yield s


SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"
