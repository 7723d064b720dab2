import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from kinlink.session import build_session, ensure_checkpoint_dir
    s = build_session("local[4]", app="kinlink-tests", shuffle_partitions=4)
    ensure_checkpoint_dir(s)
    yield s


def write_csv(path, name, df):
    """Write a pandas frame as CSV (no index) and return the file path."""
    os.makedirs(path, exist_ok=True)
    f = os.path.join(path, name)
    df.to_csv(f, index=False)
    return f


def rows(df, cols=None, key=None):
    """Collect a Spark frame as a list of dicts (sorted by ``key``)."""
    out = [r.asDict() for r in (df.select(*cols) if cols else df).collect()]
    if key:
        out.sort(key=lambda r: tuple((r[k] is None, str(r[k])) for k in key))
    return out
