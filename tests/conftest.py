import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
os.chdir(ROOT)  # fixtures are named from here

from tallyloom.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, 8, "tallyloom-tests")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def folder():
    return os.environ.get("TALLYLOOM_DATA", "/root/testdata/sf0.001")
