import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from deckframe.session import get_spark
    s = get_spark(app="deckframe-tests", master="local[4]", shuffle_partitions=4,
                  extra={"spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="deckframe-wh-")})
    s.sparkContext.setLogLevel("ERROR")
    if not s.sparkContext.getCheckpointDir() and not s.conf.get("spark.checkpoint.dir", None):
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="deckframe-test-ckpt-"))
    yield s


@pytest.fixture()
def scratch():
    return tempfile.mkdtemp(prefix="deckframe-test-")


SF_SMALL = "/root/testdata/sf0.001"
