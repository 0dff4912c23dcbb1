import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SMOKE = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from headway.session import checkpoint_dir, get_session

    s = get_session(
        app="headway-tests",
        master="local[*]",
        shuffle_partitions=8,
        conf={"spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="headway-wh-")},
    )
    checkpoint_dir(s)
    yield s
    s.stop()


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="headway-test-")
