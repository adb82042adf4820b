import pytest

from vacantis.session import build_session


@pytest.fixture(scope="session")
def spark():
    s = build_session("tests", cores="4", shuffle_partitions=4)
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def root():
    return "/root/testdata/sf0.001"
