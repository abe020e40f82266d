import pytest

from lakeledger.session import build_session


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "lakeledger-tests",
        master="local[4]",
        conf={"spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false"},
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def folder(tmp_path):
    return str(tmp_path)
