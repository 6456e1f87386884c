import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from delaylens.session import build_session  # noqa: E402

SMOKE_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    s = build_session("local[4]", 4, app_name="delaylens-tests",
                      extra={"spark.checkpoint.dir": tempfile.mkdtemp(prefix="dl-test-ckpt-", dir="/tmp")})
    yield s
    s.stop()


@pytest.fixture()
def scratch():
    return tempfile.mkdtemp(prefix="dl-test-", dir="/tmp")
