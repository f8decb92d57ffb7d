import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from tidemark.session import get_session
    scratch = tempfile.mkdtemp(prefix="tidemark-test-ckpt-")
    s = get_session("local[4]", app="tidemark-tests", shuffle_partitions=4, extra={"spark.checkpoint.dir": scratch})
    yield s
    s.stop()


@pytest.fixture(scope="session")
def tables(spark):
    from tidemark.sources.logical import logical_tables
    from tests.fixtures import raw_tables
    return logical_tables(raw_tables(spark))
