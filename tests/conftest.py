import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

DATA = os.path.join(ROOT, "tests", "data")
SAMPLE_CSV = os.path.join(DATA, "sample_transactions.csv")
SF0001 = "/root/testdata/sf0.001"
SF001 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from riskloom.session import build_session

    # build_session resolves the checkpoint folder: the configured one, or a
    # private scratch folder only when none is configured
    s = build_session("local[4]", 4, app="riskloom-tests", timezone="UTC")
    yield s
    s.stop()


@pytest.fixture()
def tmpdir_path():
    return tempfile.mkdtemp(prefix="riskloom-test-")
