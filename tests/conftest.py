import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from revisor.session import build_session

    s = build_session(master="local[4]", shuffle_partitions=8, app_name="revisor-tests")
    yield s
    s.stop()


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="revisor-test-")


SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"
