import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from roadframe.session import build_session
    session = build_session(master="local[4]", shuffle_partitions=4, app_name="roadframe-tests",
                            extra={"spark.checkpoint.dir": tempfile.mkdtemp(prefix="roadframe-tests-")})
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SMALL
