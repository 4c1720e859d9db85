import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]

from terraframe.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    folder = tmp_path_factory.mktemp("spark")
    session = local_session(
        8, "tests",
        spark__checkpoint__dir=str(folder / "checkpoint"),
        spark__sql__warehouse__dir=str(folder / "warehouse"),
        spark__driver__memory="4g",
        spark__sql__maxMetadataStringLength="4000",
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture()
def plan():
    """The physical plan of a frame as text."""

    def text(frame) -> str:
        return frame._jdf.queryExecution().executedPlan().toString()

    return text
