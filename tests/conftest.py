import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from colonnade.session import build_session

    work = tempfile.mkdtemp(prefix="colonnade-test-")
    s = build_session("local[4]", 4, "colonnade-tests",
                      extra={"spark.checkpoint.dir": os.path.join(work, "ckpt"),
                             "spark.local.dir": os.path.join(work, "local"),
                             "spark.driver.memory": "4g"})
    yield s
    s.stop()


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="colonnade-t-")
