import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from reelmart.session import get_session  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    s = get_session("local[4]", app_name="reelmart-tests", shuffle_partitions=4)
    s.sparkContext.setLogLevel("ERROR")
    s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="reelmart-test-ckpt-"))
    yield s


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="reelmart-test-")


def pytest_collection_modifyitems(items):
    # this one looks for its executions behind those there were; Spark keeps the last 1,000, so in a long session it finds none
    items.sort(key=lambda item: item.name != "test_a_load_reads_the_text_once")
