import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from check import connect, local_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session("8")
    session.sparkContext.setLogLevel("ERROR")
    if session.sparkContext.getCheckpointDir() is None:
        session.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("checkpoint")))
    return session


@pytest.fixture(scope="session")
def con():
    return connect(SMALL)


@pytest.fixture
def column(spark):
    """Evaluate a Column function on a list of values."""
    from pyspark.sql import functions as F

    def run(values, fn, schema="i int, t string"):
        df = spark.createDataFrame(list(enumerate(values)), schema)
        return [r.x for r in df.select("i", fn(F.col("t")).alias("x")).orderBy("i").collect()]

    return run
