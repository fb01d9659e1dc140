import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from veloframe.session import build_session

    scratch = tempfile.mkdtemp(prefix="veloframe-tests-")
    s = build_session(
        master="local[*]", shuffle_partitions=8, app_name="veloframe-tests",
        extra={
            "spark.sql.warehouse.dir": os.path.join(scratch, "warehouse"),
            "spark.checkpoint.dir": os.path.join(scratch, "checkpoints"),
        })
    yield s
    s.stop()


@pytest.fixture(scope="session")
def scratch_dir():
    return tempfile.mkdtemp(prefix="veloframe-data-")


@pytest.fixture(scope="session")
def small_dir():
    return SMALL
