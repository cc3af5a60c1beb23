import pytest

from kindred.session import local_session


@pytest.fixture(scope="session")
def spark():
    session = local_session(4, "kindred-tests")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
