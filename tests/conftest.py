import os
import sys

import pytest

HERE = os.path.dirname(os.path.abspath(__file__))
sys.path[:0] = [os.path.dirname(HERE), HERE]

from afterplay.session import local_session  # noqa: E402

TESTDATA = os.environ.get("AFTERPLAY_TESTDATA", "/root/testdata")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    shared = str(tmp_path_factory.mktemp("shared"))
    session = local_session(shuffle_partitions=8, conf={"spark.checkpoint.dir": shared})
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture(scope="session")
def sf_dir():
    return f"{TESTDATA}/sf0.001"
