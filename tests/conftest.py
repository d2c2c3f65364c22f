import os

import pytest

from tallymart.session import local_session

TESTDATA = os.environ.get("TESTDATA_DIR", "/root/testdata")


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, app="tallymart-tests")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_small():
    return f"{TESTDATA}/sf0.001"


@pytest.fixture(scope="session")
def sf_medium():
    return f"{TESTDATA}/sf0.01"


@pytest.fixture
def zone(spark):
    """Set the session time zone for one test."""
    before = spark.conf.get("spark.sql.session.timeZone")

    def use(name: str) -> None:
        spark.conf.set("spark.sql.session.timeZone", name)

    yield use
    spark.conf.set("spark.sql.session.timeZone", before)
