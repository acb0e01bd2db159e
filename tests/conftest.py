import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


@pytest.fixture(scope="session")
def spark():
    from onsetlake.session import build_session

    s = build_session(master="local[4]", shuffle_partitions=4, app_name="onsetlake-tests")
    yield s
    s.stop()
