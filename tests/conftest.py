import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_DIR = os.environ.get("AIRDATA_TEST_SF", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    from airdata.session import get_session
    s = get_session(os.environ.get("AIRDATA_TEST_MASTER", "local[8]"), 8, app_name="airdata-tests",
                    extra={"spark.driver.memory": "4g", "spark.checkpoint.dir": tempfile.mkdtemp(prefix="airdata-test-ckpt-")})
    yield s
    s.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="airdata-test-")
