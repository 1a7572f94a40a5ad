import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tests")]

from kinrank.session import local_session, release_tables  # noqa: E402

DATA = "/root/testdata"


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, 8)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    release_tables(session)
    session.stop()


@pytest.fixture(scope="session")
def folder():
    return f"{DATA}/sf0.001"


@pytest.fixture
def frame(spark):
    """Small ratings from triples."""

    def make(rows, schema="user_id bigint, product_id bigint, rating double"):
        return spark.createDataFrame(list(rows), schema)

    return make
