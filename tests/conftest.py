import pytest

from tarnwork.session import build_session


@pytest.fixture(scope="session")
def spark():
    session = build_session("tests", cores=4)
    yield session
    session.stop()
