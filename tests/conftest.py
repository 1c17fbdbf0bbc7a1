import pytest

from sparrowmill.session import local_session


@pytest.fixture(scope="session")
def spark():
    yield local_session(8, "tests", partitions=3)
