import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

import wavetide  # noqa: E402, F401 - before NumPy

DATA = "/root/testdata"


@pytest.fixture(scope="session")
def spark():
    from wavetide.session import local_session

    return local_session(8, 8)
