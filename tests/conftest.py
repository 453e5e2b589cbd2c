import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from clickmodel.session import local_session
    # tests look up the plans of their own runs, so none may be dropped from the list meanwhile
    s = local_session("*", shuffle_partitions=8, app="clickmodel-tests", extra={"spark.sql.ui.retainedExecutions": "100000"})
    yield s
    s.stop()


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="clickmodel-test-")
