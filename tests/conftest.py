import pytest

from heliolake.session import build_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    s = build_session("tests", "local[4]", 4, spark__sql__warehouse__dir=str(tmp_path_factory.mktemp("wh")))
    s.sparkContext.setLogLevel("ERROR")
    s.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("checkpoints")))
    return s
