import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from leadloom.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session("4", "leadloom-tests")
    session.sparkContext.setLogLevel("ERROR")
    session.conf.set("spark.leadloom.scratch", str(tmp_path_factory.mktemp("scratch")))
    yield session
    session.stop()
