import pytest

from wardstone.session import build_session


@pytest.fixture(scope="session")
def spark():
    session = build_session("wardstone-tests", 4)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
