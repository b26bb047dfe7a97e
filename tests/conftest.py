import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from clickmart.session import get_session

    # The shared folder comes from the session's own spark.checkpoint.dir;
    # clickmart.session.shared_root makes a local one only when it is unset.
    s = get_session(
        app="clickmart-tests",
        master="local[4]",
        shuffle_partitions=4,
        extra={"spark.driver.memory": "4g"},
    )
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture()
def tmp(tmp_path):
    return str(tmp_path)
