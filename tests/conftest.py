import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from orderflow.session import local_session
    s = local_session(app="orderflow-tests", cores="*", shuffle_partitions=8)
    yield s
    s.stop()


@pytest.fixture()
def tmp_root():
    # tests run locally: a local scratch folder is fine here (library code uses the session's
    # shared checkpoint folder instead)
    return tempfile.mkdtemp(prefix="orderflow-test-")
