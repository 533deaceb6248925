import datetime as dt
import sys
import tempfile
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


@pytest.fixture(scope="session")
def spark():
    from tidemark.session import get_session

    s = get_session("local[*]", shuffle_partitions=8)
    if not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="tm-test-ckpt-"))
    yield s


@pytest.fixture
def tmp_root():
    return tempfile.mkdtemp(prefix="tm-test-")


def D(s: str) -> dt.date:
    return dt.date.fromisoformat(s)


def rows(df, *cols):
    cols = cols or tuple(df.columns)
    return sorted((tuple(r[c] for c in cols) for r in df.collect()),
                  key=lambda t: tuple((v is None, v if v is not None else 0) for v in t))


def plan_text(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()
