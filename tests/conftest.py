import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

from ashgrid.session import checkpoint_root, get_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = get_session("local[4]", app="ashgrid-tests", shuffle_partitions=4)
    checkpoint_root(s)
    yield s


SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"
