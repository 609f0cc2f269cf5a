import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from wideloom.session import get_spark  # noqa: E402

SF = {s: f"/root/testdata/sf{s}" for s in ("0.001", "0.01", "0.1")}


@pytest.fixture(scope="session")
def spark():
    s = get_spark("local[*]", app="wideloom-tests", shuffle_partitions=8)
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture
def tmp_dir(tmp_path):
    return str(tmp_path)
