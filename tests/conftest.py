import os
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
os.environ.setdefault("TZ", "UTC")

from presswork.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(4, "presswork-tests")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
