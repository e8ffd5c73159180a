import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from orrery.session import build_session

    session = build_session("local[4]", 8, app_name="orrery-tests")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_small():
    return "/root/testdata/sf0.001"
