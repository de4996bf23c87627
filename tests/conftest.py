import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from cuadra.session import get_session
    s = get_session("local[4]", app="cuadra-tests", conf={
        "spark.sql.shuffle.partitions": "8",
        "spark.checkpoint.dir": tempfile.mkdtemp(prefix="cuadra-test-ckpt-"),
    })
    yield s
    s.stop()


@pytest.fixture(scope="session")
def duck():
    from tools.compare import duck as make
    return make(SF_SMALL)
