import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from adspend.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = build_session("local[4]", shuffle_partitions=4, app_name="adspend-tests",
                      extra={"spark.checkpoint.dir": tempfile.mkdtemp(prefix="adspend-test-ckpt-")})
    yield s
    s.stop()


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="adspend-test-")
