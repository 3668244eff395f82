import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from martkit.session import get_session

    s = get_session(
        "local[*]", app_name="martkit-tests", shuffle_partitions=8,
        extra={"spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="martkit-test-wh-")},
    )
    # tests only: a private checkpoint folder when the session names none
    if not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="martkit-test-ckpt-"))
    yield s
    s.stop()


@pytest.fixture(scope="session")
def sf001():
    return SF001


@pytest.fixture()
def scratch(spark):
    from martkit.session import scratch_path

    return scratch_path(spark, "test")
