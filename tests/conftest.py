import datetime as dt

import pytest

from careledger.session import local_session

AS_OF = dt.datetime(2024, 3, 10, 12, 0)


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session("8", **{
        "spark.sql.shuffle.partitions": "4",
        "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
        "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("catalog")),
    })
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def as_of():
    return AS_OF
