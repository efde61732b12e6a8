import pytest

from stackweave import session

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    spark = session.local_session(8, "tests")
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    yield spark
    spark.stop()


@pytest.fixture(scope="session")
def small():
    return SMALL
