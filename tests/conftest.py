import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from wardflow.session import build_session, checkpoint_dir
    s = build_session("local[4]", app="wardflow-tests", shuffle_partitions=8,
                      extra={"spark.checkpoint.dir": tempfile.mkdtemp(prefix="wf-test-ckpt-")})
    checkpoint_dir(s)
    yield s
    s.stop()


@pytest.fixture(scope="session")
def sf_small():
    return "/root/testdata/sf0.001"
