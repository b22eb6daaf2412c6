import datetime as dt
import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture(scope="session")
def spark():
    import tempfile

    from shiftwise.session import get_session
    # Local test run: catalog tables go to a fresh folder (a cluster names its own).
    s = get_session("local[4]", app_name="shiftwise-tests", shuffle_partitions=4,
                    extra_conf={"spark.sql.warehouse.dir":
                                tempfile.mkdtemp(prefix="shiftwise-wh-")})
    s.sparkContext.setLogLevel("ERROR")
    yield s


def ts(s: str) -> dt.datetime:
    return dt.datetime.fromisoformat(s)


def rows(df, *cols):
    """Sorted list of tuples (NULL-safe sort)."""
    cols = cols or df.columns
    out = [tuple(r[c] for c in cols) for r in df.select(*cols).collect()]
    return sorted(out, key=lambda t: tuple((True, 0) if v is None else (False, v) for v in t))
