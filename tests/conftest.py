import os

import pytest

os.environ.setdefault("PYSPARK_PYTHON", "python")
DATA = os.environ.get("TIDEMARK_TESTDATA", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    from tidemark.session import local_session

    session = local_session(4, memory="3g", partitions=4)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def data():
    return DATA
