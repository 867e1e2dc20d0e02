import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from qbank.session import build_session
    s = build_session(master="local[4]", shuffle_partitions=4, app_name="qbank-tests")
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()
