import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from starload.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session("tests", "local[4]", spark__sql__shuffle__partitions="4")
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


def rows(df, *columns):
    """Rows as a sorted list of tuples, nulls first."""
    chosen = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in chosen.collect()), key=lambda r: [(v is not None, str(v)) for v in r])
