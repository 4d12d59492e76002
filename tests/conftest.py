import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from tillscope.session import local_session

    s = local_session(cores="*", shuffle_partitions=8, app_name="tillscope-tests")
    yield s
    s.stop()


@pytest.fixture()
def scratch(spark):
    from tillscope.session import scratch_path

    return scratch_path(spark, "test")
