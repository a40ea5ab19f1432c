import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from terrace.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests", "local[8]", spark__sql__shuffle__partitions="4", spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false", spark__ui__retainedJobs="50", spark__driver__memory="8g",
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def rows():
    """Rows of a frame as a sorted list of dicts."""

    def collect(df, *keys):
        out = [r.asDict(recursive=True) for r in df.collect()]
        return sorted(out, key=lambda r: tuple(str(r[k]) for k in (keys or df.columns)))

    return collect
