import pytest

from namepulse.session import local_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session(8)
    session.conf.set("spark.sql.session.timeZone", "UTC")
    yield session
    session.stop()


@pytest.fixture
def folder(tmp_path):
    return str(tmp_path)
