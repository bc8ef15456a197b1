import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from panelspark.session import build_session, checkpoint_dir
    s = build_session("local[4]", app_name="panelspark-tests", shuffle_partitions=8)
    # tests own a scratch checkpoint folder only because none is configured
    if not s.conf.get("spark.checkpoint.dir", None):
        s.conf.set("spark.checkpoint.dir", tempfile.mkdtemp(prefix="panelspark-test-ckpt-"))
    checkpoint_dir(s)
    yield s
    s.stop()


@pytest.fixture()
def scratch(tmp_path):
    return str(tmp_path)


def rows(df, order=None):
    """Collected rows as plain tuples, sorted."""
    out = [tuple(r) for r in df.collect()]
    return sorted(out, key=lambda t: tuple((x is None, str(x)) for x in t)) if order is None else out
