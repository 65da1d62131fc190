import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from strata.session import build_session
    scratch = tempfile.mkdtemp(prefix="strata-tests-")
    s = build_session("local[*]", app="strata-tests", shuffle_partitions=8,
                      extra={"spark.driver.memory": "6g",
                             "spark.checkpoint.dir": os.path.join(scratch, "ckpt")})
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture()
def scratch():
    return tempfile.mkdtemp(prefix="strata-run-")
