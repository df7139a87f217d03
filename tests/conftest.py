import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tests")]

from harness import spark_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = spark_session(cores=4, partitions=4)
    yield session
    session.stop()


@pytest.fixture(scope="session")
def seqs(spark):
    def make(*texts):
        return spark.createDataFrame([(i, t) for i, t in enumerate(texts, 1)], "pid long, sequence string")
    return make
