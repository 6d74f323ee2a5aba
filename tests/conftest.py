import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from rankforge.session import get_session

    s = get_session("local[4]", 4, app_name="rankforge-tests",
                    extra={"spark.driver.memory": "8g"})
    s.sparkContext.setLogLevel("ERROR")
    # Tests only: the session names no shared checkpoint folder, so use a
    # scratch one (a cluster sets spark.checkpoint.dir).
    if not s.conf.get("spark.checkpoint.dir", None):
        d = tempfile.mkdtemp(prefix="rankforge-test-ckpt-")
        s.conf.set("spark.checkpoint.dir", d)
        s.sparkContext.setCheckpointDir(d)
    yield s


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="rankforge-test-")
