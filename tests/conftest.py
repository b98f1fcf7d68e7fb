import datetime as dt

import pytest

from tarkaloom.plans.session import build_session


@pytest.fixture(scope="session")
def spark():
    s = build_session("tests", master="local[4]", partitions=4)
    s.sparkContext.setLogLevel("ERROR")
    return s


@pytest.fixture(scope="session")
def day():
    return lambda n: dt.datetime(2024, 1, 1) + dt.timedelta(days=n)
