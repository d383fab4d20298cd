import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from panelgrain.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session("tests", "8", 4)
    session.sparkContext.setLogLevel("OFF")
    return session


def ordered(tuples):
    return sorted((tuple(t) for t in tuples), key=lambda t: [str(v) for v in t])


def rows(df, *columns):
    """Rows as sorted tuples."""
    shown = df.select(*columns) if columns else df
    return ordered(shown.collect())
