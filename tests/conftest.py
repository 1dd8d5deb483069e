import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.01"
SF_TINY = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from cohortlens.session import build_session

    # tests set their own checkpoint folder (the session has none)
    ckpt = tempfile.mkdtemp(prefix="cohortlens-test-ckpt-")
    warehouse = tempfile.mkdtemp(prefix="cohortlens-test-warehouse-")
    s = build_session(master="local[*]", shuffle_partitions=8,
                      extra={"spark.checkpoint.dir": ckpt, "spark.sql.warehouse.dir": warehouse})
    yield s
    s.stop()


@pytest.fixture(scope="session")
def duck():
    from compare import duck_connection

    return duck_connection(SF_SMALL)


@pytest.fixture()
def scratch():
    return tempfile.mkdtemp(prefix="cohortlens-run-")
