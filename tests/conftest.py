import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from neoflow.session import build_session, shared_dir
    s = build_session("local[4]", app_name="neoflow-tests", shuffle_partitions=4)
    # The shared folder comes from the session (spark.checkpoint.dir); only
    # when that is unset on a local master does shared_dir create a temp one.
    shared_dir(s)
    yield s
    s.stop()
