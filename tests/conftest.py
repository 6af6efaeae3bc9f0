from __future__ import annotations

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from tabforge.session import local_session  # noqa: E402

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    s = local_session("*", shuffle_partitions=8, app="tabforge-tests")
    yield s


def rows(df, *cols):
    """Collected rows as sorted tuples (optionally a column subset)."""
    sel = df.select(*cols) if cols else df
    return srt(tuple(r) for r in sel.collect())


def srt(items):
    """Sort tuples that may hold NULLs (NULL sorts last)."""
    return sorted(items, key=lambda t: tuple((1, 0) if v is None else (0, v) for v in t))
