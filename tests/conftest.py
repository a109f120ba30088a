import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from gaugeflow.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "local[8]", shuffle_partitions=8, spark__ui__showConsoleProgress="false"
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def messages(spark):
    def make(*texts):
        return spark.createDataFrame([(t,) for t in texts], "value string")

    return make


@pytest.fixture
def folder(tmp_path):
    return str(tmp_path)
