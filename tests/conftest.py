import pytest

from tidemart.session import build_session

TEST_CONF = {
    "spark.sql.shuffle.partitions": "4",
    "spark.driver.memory": "8g",
    "spark.ui.showConsoleProgress": "false",
}


@pytest.fixture(scope="session")
def spark():
    session = build_session("tidemart-tests", master="local[8]", extra=TEST_CONF)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return "/root/testdata/sf0.001"
