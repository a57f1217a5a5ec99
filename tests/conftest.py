import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF0001 = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from ledgerloom.session import get_session
    ckpt = tempfile.mkdtemp(prefix="ll-test-ckpt-", dir="/tmp")
    s = get_session("local[4]", app="ledgerloom-tests", shuffle_partitions=4,
                    extra={"spark.checkpoint.dir": ckpt})
    yield s
    s.stop()
