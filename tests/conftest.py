"""One small local session for all tests."""

import os
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
for p in (ROOT, ROOT / "tests"):
    sys.path.insert(0, str(p))
os.environ["PYTHONPATH"] = f"{ROOT}:{os.environ.get('PYTHONPATH', '')}"

DATA = Path("/root/testdata")


@pytest.fixture(scope="session")
def spark():
    from sheafline.session import local_session

    session = local_session(4, "4g", "sheafline-tests")
    session.sparkContext.setLogLevel("ERROR")
    session.conf.set("spark.sql.shuffle.partitions", "4")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def data():
    """The smallest test tables; tests that need them are skipped where they are not there."""
    root = DATA / "sf0.001"
    if not root.exists():
        pytest.skip("no test tables here")
    return str(root)
