import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from shopledger.session import local_session  # noqa: E402

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    return local_session("tests", "8", 4)


@pytest.fixture(scope="session")
def data():
    if not os.path.isdir(DATA):
        pytest.skip("test tables are not available")
    return DATA
