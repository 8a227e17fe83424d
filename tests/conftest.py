import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from gleaner.session import build_session, ship  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = ship(build_session("local[4]", 4, **{"spark.driver.memory": "3g"}))
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SF
