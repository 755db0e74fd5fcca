import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from laptrace.session import build_session

    session = build_session("tests", 8, 8)
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()
