from __future__ import annotations

import pathlib
import sys

import pytest

sys.path.insert(0, str(pathlib.Path(__file__).resolve().parent.parent))

from tallystick.session import build_session  # noqa: E402

TESTDATA = pathlib.Path("/root/testdata")


@pytest.fixture(scope="session")
def spark():
    session = build_session("tallystick-tests", "local[8]", 4)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def star_folder():
    folder = TESTDATA / "sf0.001"
    if not folder.exists():
        pytest.skip("no test data on this machine")
    return str(folder)
