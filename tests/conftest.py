import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from adspark.session import get_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = get_session("local[4]", 4, app_name="adspark-tests",
                    extra={"spark.checkpoint.dir": tempfile.mkdtemp(prefix="adspark-test-ckpt-")})
    yield s


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="adspark-test-")
