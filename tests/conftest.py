import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from barlake.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = build_session("local[4]", app_name="barlake-tests", shuffle_partitions=4)
    if s.conf.get("spark.checkpoint.dir", None) is None:
        s.conf.set("spark.checkpoint.dir", tempfile.mkdtemp(prefix="barlake-test-ckpt-"))
    yield s
    s.stop()
