import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from notemill.session import local_session
    return local_session("4", partitions=4, memory="8g")


@pytest.fixture
def texts(spark):
    """A frame of one string column with an id."""
    def make(values, column="text"):
        return spark.createDataFrame(list(enumerate(values)), f"id long, {column} string")
    return make
