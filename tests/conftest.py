import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from bourse.session import local_session

    s = local_session(cores=4, shuffle_partitions=4, app="bourse-tests")
    yield s
    s.stop()
