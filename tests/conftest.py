import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from txnlake.session import build_session, checkpoint_dir

    wh = tempfile.mkdtemp(prefix="txnlake-wh-", dir="/tmp")
    s = build_session(
        master="local[*]", shuffle_partitions=8, driver_memory="8g", extra={"spark.sql.warehouse.dir": wh}
    )
    checkpoint_dir(s)  # tests only: a local folder when the cluster names none
    yield s
    s.stop()


@pytest.fixture()
def scratch():
    """A fresh scratch folder per test (never reused, never cleared)."""
    return tempfile.mkdtemp(prefix="txnlake-test-", dir="/tmp")
