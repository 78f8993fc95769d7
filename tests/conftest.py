import datetime as dt
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

from sensorlake.session import get_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = get_session("local[4]", app_name="sensorlake-tests", shuffle_partitions=8)
    yield s


def D(s: str) -> dt.date:
    return dt.date.fromisoformat(s)


@pytest.fixture(scope="session")
def raw_counts_schema():
    from sensorlake.schemas import RAW_COUNTS

    return RAW_COUNTS


def rows(df, *cols):
    """Collected rows as sorted tuples of ``cols`` (all columns by default)."""
    cols = cols or tuple(df.columns)
    return sorted((tuple(r[c] for c in cols) for r in df.collect()),
                  key=lambda t: tuple((v is None, v if v is not None else 0) for v in t))
