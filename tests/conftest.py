import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.join(ROOT, "tests"))

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from daybook.session import local_session

    s = local_session(cores=4, shuffle_partitions=4, app="daybook-tests")
    yield s


@pytest.fixture(scope="session")
def sf_small():
    return SMALL


@pytest.fixture()
def scratch(tmp_path):
    return str(tmp_path)
