import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from corpusloom.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = build_session(4, 4, "4g")
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()
