import pytest

from tillflow.session import get_spark


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    folder = tmp_path_factory.mktemp("spark")
    session = get_spark("tests", master="local[8]", spark__sql__shuffle__partitions="8", spark__ui__enabled="false",
                        spark__ui__showConsoleProgress="false", spark__driver__memory="4g",
                        spark__sql__warehouse__dir=str(folder / "warehouse"))
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
