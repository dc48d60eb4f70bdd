import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF0001 = "/root/testdata/sf0.001"
SF001 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from centroidal.session import get_session
    s = get_session("local[4]", 4)
    yield s
    s.stop()


@pytest.fixture()
def tmpdir_run():
    """A fresh scratch directory per test (never reused, never cleared)."""
    return tempfile.mkdtemp(prefix="centroidal-test-")
