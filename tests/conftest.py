import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from vitrine.session import build_session  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = build_session("local[4]", 4, "vitrine-tests")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf():
    return SF
