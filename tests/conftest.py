import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from ledgerlake.session import get_session

    s = get_session("local[*]", 8, extra={"spark.driver.memory": "4g"})
    # Tests own their session: set a checkpoint folder only because none is set.
    if not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="ledgerlake-test-ckpt-"))
    yield s


SF_SMALL = "/root/testdata/sf0.001"
