import sys
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
sys.path.insert(0, str(Path(__file__).resolve().parent))

import pytest

from tillwise.session import get_session


@pytest.fixture(scope="session")
def spark():
    s = get_session("tests", master="local[8]", partitions=4)
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()
