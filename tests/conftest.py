import sys
import tempfile
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from orderflow.session import build_session
    s = build_session("local[4]", shuffle_partitions=8)
    # Tests own the checkpoint folder; library code only reads it from the session.
    s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="orderflow-test-ckpt-"))
    yield s
    s.stop()


@pytest.fixture()
def tmp(tmp_path):
    return str(tmp_path)
