import os
import sys
from datetime import datetime

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from ledgerlens.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = local_session(cores=4, shuffle_partitions=4, app="ledgerlens-tests")
    yield s
    s.stop()


def ts(day: int, hour: int = 0) -> datetime:
    return datetime(2024, 1, day, hour)
