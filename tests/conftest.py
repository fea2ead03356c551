import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from sportmart.session import build_session, remove_shared  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "sportmart-tests",
        master="local[8]",
        spark__sql__shuffle__partitions="8",
        spark__driver__memory="8g",
        spark__driver__host="127.0.0.1",
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    remove_shared(session)
    session.stop()
