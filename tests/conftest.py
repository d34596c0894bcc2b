import os
import sys
from pathlib import Path

import pytest

ROOT = str(Path(__file__).resolve().parent.parent)
for folder in (ROOT, str(Path(__file__).resolve().parent)):
    if folder not in sys.path:
        sys.path.insert(0, folder)
# Python workers import the package and the tests' own feed function.
os.environ["PYTHONPATH"] = os.pathsep.join([ROOT, str(Path(__file__).resolve().parent), os.environ.get("PYTHONPATH", "")])

from cityweave.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session("tests", **{"spark.sql.shuffle.partitions": "4"})
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
