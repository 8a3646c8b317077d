import pytest

from periodica import build_session


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests", "local[8]", spark_sql_shuffle_partitions="8", spark_ui_enabled="false",
        spark_ui_showConsoleProgress="false",
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
