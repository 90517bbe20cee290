import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from salesmart.session import get_spark

    ckpt = tempfile.mkdtemp(prefix="salesmart-test-ckpt-")
    s = get_spark("local[4]", 4, app="salesmart-tests", extra={"spark.checkpoint.dir": ckpt})
    s.sparkContext.setCheckpointDir(ckpt)
    yield s
    s.stop()


@pytest.fixture()
def tmp_root(tmp_path):
    return str(tmp_path)
