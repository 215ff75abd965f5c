import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from stratus.session import local_session

    s = local_session("stratus-tests", "*", 8)
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()
