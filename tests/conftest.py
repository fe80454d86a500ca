import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from parley.session import build_session
    wh = tempfile.mkdtemp(prefix="parley-wh-")
    s = build_session(master="local[4]", app="parley-tests", shuffle_partitions=4,
                      extra={"spark.sql.warehouse.dir": wh})
    yield s
    s.stop()
