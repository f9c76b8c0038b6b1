import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tidemark.session import local_session

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = local_session(os.environ.get("TEST_CPUS", "8"), shuffle_partitions=4, memory="8g")
    yield session
    session.stop()


@pytest.fixture
def tiny_slices(spark):
    """Cut every ordered group after a few rows."""
    spark.conf.set("tidemark.rowsPerSlice", "60")
    yield 60
    spark.conf.unset("tidemark.rowsPerSlice")
