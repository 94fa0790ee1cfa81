import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from feedloom.session import local


@pytest.fixture(scope="session")
def spark():
    session = local(4, memory="4g", partitions=4)
    yield session
    session.stop()
