import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from marquee.session import local_session  # noqa: E402

SMOKE_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = local_session()
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def smoke_dir():
    return SMOKE_DIR


@pytest.fixture(scope="session")
def smoke(spark):
    from marquee.plans.warehouse import warehouse

    return warehouse(spark, SMOKE_DIR)


@pytest.fixture
def set_conf(spark):
    """Sets a setting for the length of a test."""
    old = {}

    def put(key, value):
        old.setdefault(key, spark.conf.get(key, None))
        spark.conf.set(key, value)

    yield put
    for key, value in old.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)
