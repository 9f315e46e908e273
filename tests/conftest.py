import os
import sys
import tempfile
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))


@pytest.fixture(scope="session")
def spark():
    from forgestat.session import build_session, checkpoint_dir
    scratch = tempfile.mkdtemp(prefix="forgestat-tests-")
    os.environ.setdefault("FORGESTAT_SCRATCH", scratch)
    s = build_session("local[4]", app="forgestat-tests", shuffle_partitions=8,
                      extra={"spark.sql.warehouse.dir": os.path.join(scratch, "warehouse")})
    checkpoint_dir(s)
    yield s
    s.stop()


@pytest.fixture()
def scratch(tmp_path):
    return str(tmp_path)


def rows(df, order=None):
    """Collect as a list of dicts (sorted by ``order`` columns when given)."""
    out = [r.asDict(recursive=True) for r in df.collect()]
    if order:
        out.sort(key=lambda d: tuple((d[c] is None, d[c]) for c in order))
    return out
