import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from roomstar.session import build_session
    ck = tempfile.mkdtemp(prefix="roomstar-test-ckpt-")
    s = build_session("local[4]", app="roomstar-tests", shuffle_partitions=4,
                      extra={"spark.checkpoint.dir": ck, "spark.driver.memory": "4g"})
    yield s
    s.stop()


@pytest.fixture()
def scratch(tmp_path):
    return str(tmp_path)
