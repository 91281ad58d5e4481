import sys
from pathlib import Path

import pytest

sys.path[:0] = [str(Path(__file__).resolve().parent.parent)]


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from wayforge.session import local_session

    session = local_session("4", 4, spark__sql__adaptive__coalescePartitions__enabled="true")
    if not session.sparkContext.getCheckpointDir():
        session.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("checkpoint")))
    return session


SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def sf_dir():
    return SMALL
