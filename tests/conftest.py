import pytest

from tallyforge.session import local_session


@pytest.fixture(scope="session")
def spark():
    s = local_session("4", partitions=4, spark__driver__memory="4g")
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()
