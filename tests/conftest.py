from __future__ import annotations

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

from tickforge.session import get_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    s = get_session(
        app_name="tickforge-tests",
        master="local[4]",
        conf={"spark.sql.shuffle.partitions": "8"},
    )
    s.sparkContext.setLogLevel("ERROR")
    yield s


def rows(df, *cols):
    """Collected rows as tuples, in the given column order."""
    return [tuple(r[c] for c in cols) for r in df.collect()]
