import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from sectorpulse.session import build_session, configure
    s = build_session("local[4]", app="sectorpulse-tests", shuffle_partitions=4)
    configure(s)
    yield s
    s.stop()


@pytest.fixture
def tmp_dir(spark):
    from sectorpulse.session import scratch_path
    return scratch_path(spark, "test")
