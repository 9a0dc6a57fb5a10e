from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from roadpulse.session import local_session

    session = local_session()
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf() -> str:
    return SF


def rows(df, *keys):
    """Collected rows as dicts, sorted by ``keys``."""
    out = [r.asDict(recursive=True) for r in df.collect()]
    return sorted(out, key=lambda r: tuple(str(r[k]) for k in keys)) if keys else out


def same(a, b):
    """Both frames hold the same rows, in any order, and some."""
    left, right = (sorted(map(str, df.collect())) for df in (a, b))
    assert left and left == right
