import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from ordermill.session import get_spark
    s = get_spark("ordermill-tests", master="local[4]", shuffle_partitions=4)
    yield s
    s.stop()


@pytest.fixture()
def tmp(tmp_path_factory):
    return str(tmp_path_factory.mktemp("run"))


SF_SMALL = "/root/testdata/sf0.001"
